"""Landed XML and JSON read element by element, so that one large file has many tasks.

Spark's text reader cuts a file at any separator and splits it between tasks. Separated
at the end of an element, each row holds one element, and what surrounds the elements.
The place of a row is its file, the start of its split and its number in the split, so
document order survives; the few facts about a whole file (where its first bad element
is, where its array ends) are aggregates over places, joined back by file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.schemas import FEED, SENTIMENT_PAYLOAD
from daybook.sources.feeds import ITEMS_PER_FEED, XML_OPTIONS, first_leaves
from daybook.sources.sentiment import required

ITEM_END = "</item>"
_ITEM = r"(?s)<item(?:\s[^>]*)?>(?!.*<item[\s>]).*"
_LAST_OBJECT = r"(?s)\{[^{]*$"


def _elements(spark: SparkSession, path: str, end: str, folders: list[str]) -> DataFrame:
    """(folders.., file, _place, _text): the text up to each ``end``, and the file's rest."""
    rows = spark.read.option("lineSep", end).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    return rows.select(
        *[F.col(c).cast("string").alias(c) for c in folders],
        F.col("_metadata.file_path").alias("file"),
        place.alias("_place"),
        F.col("value").alias("_text"),
    )


def landed_feed_items(spark: SparkSession, path: str, n: int = ITEMS_PER_FEED) -> DataFrame:
    """The first ``n`` items of every landed feed, as ``feed_items`` gives them, with its
    ``event_date`` folder and ``file``.

    For feeds of any size with their items in document order, in one channel or under
    the root. Only complete items count; a feed ends at the first item that does not
    parse or lacks title or date. What lies around the items is not checked, so a feed
    that breaks off keeps the items before the break.
    """
    rows = _elements(spark, path, ITEM_END, ["event_date"])
    text = F.regexp_extract("_text", _ITEM, 0)
    item = F.from_xml(F.concat(text, F.lit(ITEM_END)), _item_schema(), XML_OPTIONS)
    places = rows.groupBy("file").agg(F.max("_place").alias("_rest"))
    items = rows.where(F.instr("_text", "<item") > 0).select("event_date", "file", "_place", item.alias("_item"))
    bad = F.col("_item._malformed").isNotNull() | (F.size("_item.title") < 1) | (F.size("_item.pubDate") < 1)
    usable = F.coalesce(~bad & (F.get("_item.title", 0).isNotNull()) & (F.get("_item.pubDate", 0).isNotNull()), F.lit(False))
    judged = items.withColumn("_usable", usable)
    stops = judged.where(~F.col("_usable")).groupBy("file").agg(F.min("_place").alias("_stop"))
    whole = judged.join(places, "file").join(stops, "file", "left").where(
        (F.col("_place") < F.col("_rest")) & (F.col("_stop").isNull() | (F.col("_place") < F.col("_stop")))
    )
    in_order = Window.partitionBy("file").orderBy("_place")
    first = whole.withColumn("_nth", F.row_number().over(in_order)).where(F.col("_nth") <= n)
    leaf = first_leaves(F.col("_item"))
    return first.select(
        "event_date", "file", (F.col("_nth") - 1).alias("position"),
        leaf["title"].alias("title"), leaf["pubDate"].alias("pub_date"), leaf["source"].alias("source"), leaf["link"].alias("link"),
    )


def _item_schema() -> str:
    leaves = ", ".join(f.simpleString() for f in FEED["item"].dataType.elementType.fields)
    return f"struct<{leaves}, _malformed: string>"


def landed_sentiment_days(spark: SparkSession, path: str) -> DataFrame:
    """The elements of ``data`` of landed payloads of any size, as ``sentiment_days``.

    Elements are flat objects, one payload a file. As there, a payload without ``data``
    and an element that is broken or has no numeric time or value is an error; so is
    one with braces in its texts, which has to be read whole.
    """
    rows = _elements(spark, path, "}", [])
    begins, ends = F.col("_text").rlike(r'"data"\s*:\s*\['), F.col("_text").rlike(r"^\s*\]")
    bounds = rows.groupBy("file").agg(
        F.min(F.when(begins, F.col("_place"))).alias("_from"),
        F.collect_set(F.when(ends, F.col("_place"))).alias("_ends"),
    )
    bounds = bounds.select(
        "file",
        F.coalesce("_from", F.raise_error(F.concat(F.lit("sentiment payload without data: "), "file"))).alias("_from"),
        F.array_min(F.filter("_ends", lambda p: p >= F.col("_from"))).alias("_to"),
    )
    # an array without elements ends in the row that begins it
    empty = F.col("_text").rlike(r'"data"\s*:\s*\[\s*\]')
    inside = rows.join(bounds, "file").where(
        (F.col("_place") >= F.col("_from")) & (F.col("_to").isNull() | (F.col("_place") < F.col("_to"))) & ~empty
    )
    text = F.concat(F.regexp_extract("_text", _LAST_OBJECT, 0), F.lit("}"))
    entry = F.from_json(text, SENTIMENT_PAYLOAD["data"].dataType.elementType, {"mode": "FAILFAST"})
    return inside.where(F.instr("_text", "{") > 0).select(entry.alias("_entry")).select(*required())

