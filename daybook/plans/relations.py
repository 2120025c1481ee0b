"""The market relations as derived from the star-schema test tables.

Orders stand for trades: the priority is the asset and the order with the
highest key gives the close of a day. Line items give two daily index series,
documents are headlines, and pages are feeds with their navigation links as
items. Everything is built from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.anomalies import key_events_from
from daybook.operators.series import daily_return

LINK = r'<li><a href="([^"]*)">([^<]*)</a></li>'


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def prices_between(spark: SparkSession, folder: str, clip=lambda df: df) -> DataFrame:
    """One close per asset and day, from the orders that ``clip`` lets through."""
    return (
        clip(table(spark, folder, "orders"))
        .groupBy(F.col("o_orderpriority").alias("asset"), F.to_date("o_orderdate").alias("date"))
        .agg(F.max_by("o_totalprice", "o_orderkey").alias("close"))
    )


def prices(spark: SparkSession, folder: str) -> DataFrame:
    return prices_between(spark, folder)


def returns(spark: SparkSession, folder: str) -> DataFrame:
    return daily_return(prices(spark, folder))


def quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Prices in the layout of landed quote files."""
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("asset"), F.to_date("o_orderdate").alias("Date"))
        .agg(
            F.min_by(price, key).alias("Open"),
            F.max(price).alias("High"),
            F.min(price).alias("Low"),
            F.max_by(price, key).alias("Close"),
            F.count(F.lit(1)).alias("Volume"),
        )
        .select("Date", "Open", "High", "Low", "Close", "Volume", "asset")
    )


def fear_greed(spark: SparkSession, folder: str) -> DataFrame:
    """A daily index between 0 and 100 with its class."""
    value = (F.sum("l_quantity").cast("long") % F.lit(101)).cast("int")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(value.alias("fng_value"))
        .select(
            "date",
            "fng_value",
            F.when(F.col("fng_value") < 50, "Fear").otherwise("Greed").alias("fng_classification"),
        )
    )


def vix(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(F.count(F.lit(1)).cast("double").alias("vix_close"))
    )


def _headline_day(key: str):
    """Days in turn, a week apart, over most of the order dates."""
    return F.date_add(F.lit("1995-01-01").cast("date"), (F.col(key) * 7 % 2400).cast("int"))


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as headlines of a day, whole text as the title."""
    return table(spark, folder, "documents").select(
        F.date_format(_headline_day("doc_id"), "yyyy-MM-dd").alias("event_date"),
        F.col("doc_id").alias("position"),
        F.col("text").alias("title"),
        F.date_format(_headline_day("doc_id"), "yyyy-MM-dd").alias("pub_date"),
        "source",
        F.lit(None).cast("string").alias("link"),
    )


def _day_of(key: str):
    return F.date_add(F.lit("1995-01-01").cast("date"), (F.col(key) % 365).cast("int"))


def key_events_table(spark: SparkSession, folder: str) -> DataFrame:
    return key_events_from(returns(spark, folder), fear_greed(spark, folder), vix(spark, folder))


def _escaped(text):
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def page_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as an RSS document: its navigation links are the items.

    A link text that ends in punctuation makes an item without title, one of odd
    length an item without source.
    """
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    links = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(LINK), 1).alias("link"),
        F.regexp_extract_all("html", F.lit(LINK), 2).alias("title"),
    )

    def item(link):
        title = F.when(link["title"].rlike("[.,]$"), "").otherwise(
            F.concat(F.lit("<title>"), link["title"], F.lit("</title>"))
        )
        source = F.when(F.length(link["title"]) % 2 == 1, "").otherwise(
            F.concat(F.lit('<source url="https://'), host, F.lit('">'), host, F.lit("</source>"))
        )
        return F.concat(
            F.lit("<item>"),
            title,
            F.lit("<pubDate>"),
            "event_date",
            F.lit("</pubDate>"),
            source,
            F.lit("<link>"),
            link["link"],
            F.lit("</link></item>"),
        )

    return (
        table(spark, folder, "pages")
        .withColumn("event_date", F.date_format(_day_of("page_id"), "yyyy-MM-dd"))
        .select(
            "page_id",
            "event_date",
            F.concat(
                F.lit("<rss><channel><title>"),
                _escaped(F.col("url")),
                F.lit("</title>"),
                F.array_join(F.transform(links, item), ""),
                F.lit("</channel></rss>"),
            ).alias("feed"),
        )
    )


def broken_page_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """``page_feeds`` that break off inside one of their first four items, if they have it."""
    return page_feeds(spark, folder).withColumn("feed", F.expr("substring_index(feed, '<pubDate>', CAST(1 + page_id % 4 AS INT))"))


def day_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """One feed per day with the items of all its pages, by page and place."""
    opening, closing = "<rss><channel>", "</channel></rss>"
    items = F.regexp_extract_all("feed", F.lit("(?s)<item>.*?</item>"), 0)
    pages = page_feeds(spark, folder).select("event_date", F.struct("page_id", F.array_join(items, "").alias("items")).alias("page"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("page")), lambda p: p["items"]), "")
    return pages.groupBy("event_date").agg(F.concat(F.lit(opening), joined, F.lit(closing)).alias("feed"))


def document_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a one-item RSS document; German ones break off early."""
    start = F.concat(F.lit("<rss><channel><item><title>"), _escaped(F.col("text")), F.lit("</title>"))
    rest = F.lit("<pubDate>1995-01-01</pubDate></item></channel></rss>")
    return table(spark, folder, "documents").select(
        "doc_id", F.when(F.col("lang") == "de", start).otherwise(F.concat(start, rest)).alias("feed")
    )


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The sentiment index as JSON payloads, one per month, so at most 31 entries each."""
    return monthly_payloads(spark, folder).drop("month")


def monthly_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``payloads`` with the month of each."""
    entry = F.struct(
        F.col("fng_value").cast("string").alias("value"),
        F.col("fng_classification").alias("value_classification"),
        (F.unix_date("date").cast("long") * 86400).cast("string").alias("timestamp"),
    )
    return (
        fear_greed(spark, folder)
        .groupBy(F.trunc("date", "month").alias("month"))
        .agg(F.collect_list(entry).alias("data"))
        .select("month", F.to_json(F.struct(F.lit("index").alias("name"), "data", F.struct(F.lit("none").alias("error")).alias("metadata"))).alias("payload"))
    )
