"""Search requests for event days, and their headlines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.concat import repeated_in_order
from daybook.schemas import HEADLINE_SEPARATOR, NEWS_REQUEST

ITEMS_PER_EVENT = 3


def news_request_plan(events: DataFrame, request: str = NEWS_REQUEST) -> DataFrame:
    """One search request per event day: the day before to the day after."""
    day = F.to_date("date")
    windows = events.select(
        F.date_format(day, "yyyy-MM-dd").alias("event_date"),
        F.date_format(F.date_sub(day, 1), "yyyy-MM-dd").alias("after"),
        F.date_format(F.date_add(day, 1), "yyyy-MM-dd").alias("before"),
    )
    return windows.withColumn("url", F.format_string(request, "after", "before"))


def _day(items: DataFrame) -> Column:
    return F.to_date(items["event_date"])


def items_of_events(items: DataFrame, events: DataFrame) -> DataFrame:
    """Items whose day is an event day.

    Meant for ``events`` read from its stored table: Spark then knows its size,
    and sends the dates to the items as long as that is below the broadcast
    threshold, so that no item is shuffled. Beyond it both sides are.
    """
    days = events.select(F.to_date("date").alias("_event_day"))
    return items.join(days, _day(items) == days["_event_day"], "left_semi")


def first_items(items: DataFrame, n: int = ITEMS_PER_EVENT, *order: str) -> DataFrame:
    """The first ``n`` items of each event day in feed order.

    The limit is applied before the shuffle too. Filter to event days first: the
    rows are sorted locally for it.
    """
    in_order = Window.partitionBy("event_date").orderBy(*(order or ["position"]))
    return items.withColumn("_nth", F.row_number().over(in_order)).where(F.col("_nth") <= n).drop("_nth")


def enrich_events(
    events: DataFrame,
    items: DataFrame,
    first: int | None = None,
    order: str = "position",
    separator: str = HEADLINE_SEPARATOR,
) -> DataFrame:
    """Events with the titles and sources of their day, each list sorted on its own.

    Items are reduced to one row per day before the join: copies of a text are
    counted before the shuffle, titles and sources in the same pass. Days
    without items keep their row, with NULL in both columns.
    """
    wanted = items_of_events(items, events)
    if first is not None:
        wanted = first_items(wanted, first, order)
    texts = F.array(
        F.struct(F.lit("title").alias("_part"), F.col("title").alias("_text")),
        F.struct(F.lit("source").alias("_part"), F.col("source").alias("_text")),
    )
    counted = (
        wanted.select(_day(wanted).alias("date"), F.inline(texts))
        .groupBy("date", "_part", "_text")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    per_day = counted.groupBy("date").agg(
        *[
            repeated_in_order(f"IF(_part = '{part}', _text, NULL)", "_copies", separator).alias(f"news_{part}s")
            for part in ("title", "source")
        ]
    )
    joined = events.withColumn("date", F.to_date("date")).join(per_day, "date", "left")
    return joined.select(*events.columns, "news_titles", "news_sources").orderBy("year", "rank")


def event_headlines(items: DataFrame, n: int = ITEMS_PER_EVENT, order: str = "position") -> DataFrame:
    """The first ``n`` items per day as an array of structs, bounded by ``n``.

    The concatenated strings cannot be split again when a title contains the
    separator; this column can.
    """
    return (
        first_items(items, n, order)
        .groupBy(F.to_date("event_date").alias("date"))
        .agg(F.sort_array(F.collect_list(F.struct(order, "title", "source", "link"))).alias("headlines"))
    )
