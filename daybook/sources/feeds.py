"""News feeds: XML documents with repeated ``item`` elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.schemas import FEED

ITEMS_PER_FEED = 3


def landed_feeds(spark: SparkSession, path: str, with_file: bool = False) -> DataFrame:
    """One row per landed file below ``event_date=<day>`` folders, text in ``feed``.

    ``with_file`` adds the file's path, which orders the feeds of one day.
    """
    file = [F.col("_metadata.file_path").alias("file")] if with_file else []
    return spark.read.text(path, wholetext=True).select(
        F.col("event_date").cast("string").alias("event_date"), *file, F.col("value").alias("feed")
    )


XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "ignoreSurroundingSpaces": "false",
}
_WHOLE_ITEM = r"(?s)<item(?:\s[^>]*)?>.*?</item>"


def first_leaves(item: Column) -> Column:
    """An item with the first of each of its repeated children."""
    leaves = FEED["item"].dataType.elementType.names
    return F.struct(*[F.get(item[name], 0).alias(name) for name in leaves])


def _recovered(column: str) -> Column:
    """The items of a document that breaks off or is broken: its complete items, parsed
    one by one, up to the first that does not parse."""
    leaves = ", ".join(f.simpleString() for f in FEED["item"].dataType.elementType.fields)
    texts = F.regexp_extract_all(F.col(column), F.lit(_WHOLE_ITEM), 0)
    parsed = F.transform(texts, lambda t: F.from_xml(t, f"struct<{leaves}, _malformed: string>", XML_OPTIONS))
    bad = F.array_position(F.transform(parsed, lambda item: item["_malformed"].isNotNull()), True)
    kept = F.slice(parsed, F.lit(1), F.when(bad == 0, F.size(parsed)).otherwise(bad - 1).cast("int"))
    return F.transform(kept, first_leaves)


def _parsed(documents: DataFrame, column: str) -> DataFrame:
    feed = F.from_xml(F.col(column), FEED.simpleString(), XML_OPTIONS)
    none = F.array().cast(FEED["item"].dataType)
    of_channels = F.flatten(F.transform("_feed.channel", lambda c: F.coalesce(c["item"], none)))
    found = F.concat(F.coalesce(of_channels, none), F.coalesce("_feed.item", none))
    broken = F.col("_feed._malformed").isNotNull()
    # items in places that are not looked at make the document one to report
    lost = F.col(column).rlike(r"<item[\s>]") & (F.size(found) == 0)
    return documents.withColumn("_feed", feed).select(
        *[c for c in documents.columns if c != column],
        F.when(broken, _recovered(column)).otherwise(F.transform(found, first_leaves)).alias("_items"),
        (broken | lost).alias("_is_malformed"),
    )


def _kept(n: int) -> Column:
    """The first ``n`` items, ending before the first without title or date.

    A feed is read in order and given up at the first item that lacks a required
    child; what came before stays.
    """
    lacking = F.transform("_items", lambda item: item["title"].isNull() | item["pubDate"].isNull())
    first_bad = F.coalesce(F.array_position(lacking, True), F.lit(0))
    usable = F.when(first_bad == 0, F.size("_items")).otherwise(first_bad - 1)
    return F.slice("_items", F.lit(1), F.least(F.lit(n), usable).cast("int"))


def feed_items(documents: DataFrame, n: int = ITEMS_PER_FEED, column: str = "feed") -> DataFrame:
    """Up to ``n`` items per document in document order, ``position`` from 0.

    The items of all channels come first, then those under the root. A document that
    breaks off or is broken gives the complete items before the bad place, in document
    order, and is listed by ``malformed_feeds`` as well; it does not affect the others.
    """
    parsed = _parsed(documents, column)
    others = [c for c in parsed.columns if not c.startswith("_")]
    return parsed.select(*others, F.posexplode(_kept(n)).alias("position", "_item")).select(
        *others,
        "position",
        F.col("_item.title").alias("title"),
        F.col("_item.pubDate").alias("pub_date"),
        F.col("_item.source").alias("source"),
        F.col("_item.link").alias("link"),
    )


def malformed_feeds(documents: DataFrame, column: str = "feed") -> DataFrame:
    """Documents that could not be parsed, or whose items are in other places."""
    parsed = _parsed(documents, column)
    others = [c for c in parsed.columns if not c.startswith("_")]
    return parsed.where("_is_malformed").select(*others)


def feed_item_counts(documents: DataFrame, n: int = ITEMS_PER_FEED, column: str = "feed") -> DataFrame:
    """Items found and kept per well-formed document."""
    parsed = _parsed(documents, column)
    others = [c for c in parsed.columns if not c.startswith("_")]
    return parsed.where(~F.col("_is_malformed")).select(
        *others,
        F.coalesce(F.size("_items"), F.lit(0)).alias("found"),
        F.coalesce(F.size(_kept(n)), F.lit(0)).alias("kept"),
    )
