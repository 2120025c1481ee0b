"""The whole refresh: landed files to tables, key events, headlines and exports.

    spark-submit --py-files daybook.zip daybook/plans/refresh.py \\
        --quotes ... --volatility ... --sentiment ... --feeds ... --out ...

Every table is written once and later steps read the written table, so that a
lost executor costs the work of one step and not of all before it.

``out`` is a folder, whose tables are replaced one by one, or ``Snapshots``: then all
tables of a stage are published together at its end. The command uses the latter.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from daybook.operators.anomalies import key_events_from
from daybook.operators.metrics import portfolio_metrics
from daybook.operators.news import ITEMS_PER_EVENT, enrich_events, first_items, items_of_events, news_request_plan
from daybook.operators.ranges import between_dates, history_window
from daybook.operators.series import cumulative_return
from daybook.schemas import FEAR_GREED, KEY_EVENTS, KEY_EVENTS_NEWS, METRICS, PRICES, VIX
from daybook.sinks import ROWS_PER_FILE, export_tables, side_by_side, storing, write_csv
from daybook.snapshots import Draft, Snapshots
from daybook.sources.feeds import feed_items, landed_feeds
from daybook.sources.prices import landed_prices, landed_volatility
from daybook.sources.sentiment import landed_payloads, sentiment_days

# The dates of a refresh that names none.
START_DATE = "2020-01-01"
END_DATE = "2025-12-31"


def load_tables(
    spark: SparkSession,
    quotes: str,
    volatility: str,
    payloads: str,
    out: str | Draft,
    start: str = START_DATE,
    end: str = END_DATE,
) -> dict[str, DataFrame]:
    """Prices, metrics, sentiment and volatility tables from landed files.

    Closes are stored first: the series operators scan their input twice, and the
    second scan of three stored columns is much cheaper than parsing text again.
    """
    keep = storing(out)
    landed = history_window(landed_prices(spark, quotes), "date", start, end)
    closes = keep("closes", landed)
    prices = keep("prices", cumulative_return(closes).to(PRICES))
    metrics = portfolio_metrics(prices.select("asset", "date", "close"))
    sentiment = between_dates(sentiment_days(landed_payloads(spark, payloads)), "date", start, end)
    index = history_window(landed_volatility(spark, volatility), "date", start, end)
    independent = {"metrics": metrics.to(METRICS), "fear_greed": sentiment.to(FEAR_GREED), "vix": index.to(VIX)}
    written = side_by_side([lambda n=n, df=df: keep(n, df) for n, df in independent.items()])
    return {"prices": prices} | dict(zip(independent, written, strict=True))


def load_events(tables: dict[str, DataFrame], out: str | Draft) -> dict[str, DataFrame]:
    """The ranked days, and the search request of each."""
    keep = storing(out)
    events = key_events_from(tables["prices"], tables["fear_greed"], tables["vix"])
    written = keep("key_events", events.to(KEY_EVENTS))
    return {"key_events": written, "news_requests": keep("news_requests", news_request_plan(written))}


def load_headlines(spark: SparkSession, events: DataFrame, feeds: str, out: str | Draft) -> DataFrame:
    """Headlines of the event days from the feeds landed for the requests.

    A day keeps its first three, over all its feeds in the order of their names.
    """
    documents = items_of_events(landed_feeds(spark, feeds, with_file=True), events)
    items = first_items(feed_items(documents), ITEMS_PER_EVENT, "file", "position")
    return storing(out)("key_events_news", items.to(KEY_EVENTS_NEWS))


def unanswered_requests(spark: SparkSession, requests: DataFrame, feeds: str) -> DataFrame:
    """Requests for whose day no feed has been landed."""
    answered = landed_feeds(spark, feeds).select("event_date").distinct()
    return requests.join(answered, "event_date", "left_anti")


def export(spark: SparkSession, tables: dict[str, DataFrame], out: str) -> DataFrame:
    """CSV copies of the tables, and of the events with their headlines, below ``out``."""
    names = ("prices", "metrics", "key_events", "key_events_news")
    counts = export_tables(spark, {n: tables[n] for n in names}, out)
    merged = enrich_events(tables["key_events"], tables["key_events_news"])
    write_csv(merged, f"{out}/key_events_with_news.csv", rows_per_file=ROWS_PER_FILE)
    return counts


def refresh_events(
    spark: SparkSession, quotes: str, volatility: str, payloads: str, out: str | Snapshots, **dates: str
) -> DataFrame:
    """First stage: tables and ranked days; returns the search requests to answer."""
    if isinstance(out, Snapshots):
        with out.draft() as draft:
            tables = load_tables(spark, quotes, volatility, payloads, draft, **dates)
            return load_events(tables, draft)["news_requests"]
    return load_events(load_tables(spark, quotes, volatility, payloads, out, **dates), out)["news_requests"]


def refresh_headlines(spark: SparkSession, feeds: str, out: str | Snapshots) -> DataFrame:
    """Second stage, after feeds were landed for the requests: headlines and exports.

    Requests without a feed are stored as ``unanswered_requests``. The exports of a
    version lie beside its tables.
    """
    if isinstance(out, Snapshots):
        tables = out.tables()
        with out.draft() as draft:
            return _headlines(spark, feeds, tables, draft, draft.path("export"))
    names = ("prices", "metrics", "key_events", "news_requests")
    return _headlines(spark, feeds, {n: spark.read.parquet(f"{out}/{n}") for n in names}, out, f"{out}/export")


def _headlines(spark: SparkSession, feeds: str, tables: dict[str, DataFrame], out: str | Draft, exports: str) -> DataFrame:
    storing(out)("unanswered_requests", unanswered_requests(spark, tables["news_requests"], feeds))
    return export(spark, tables | {"key_events_news": load_headlines(spark, tables["key_events"], feeds, out)}, exports)


def refresh(
    spark: SparkSession, quotes: str, volatility: str, payloads: str, feeds: str, out: str | Snapshots, **dates: str
) -> DataFrame:
    """Both stages, where the feeds of all days are landed already."""
    refresh_events(spark, quotes, volatility, payloads, out, **dates)
    return refresh_headlines(spark, feeds, out)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("quotes", "volatility", "sentiment", "feeds", "out"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--stage", choices=("events", "headlines", "all"), default="all")
    parser.add_argument("--start", default=START_DATE)
    parser.add_argument("--end", default=END_DATE)
    given = parser.parse_args()
    spark = SparkSession.builder.appName("daybook refresh").getOrCreate()
    out = Snapshots(spark, given.out)
    if given.stage != "headlines":
        requests = refresh_events(
            spark, given.quotes, given.volatility, given.sentiment, out, start=given.start, end=given.end
        )
        requests.show(truncate=False)
    if given.stage != "events":
        refresh_headlines(spark, given.feeds, out).show(truncate=False)
    out.expire()


if __name__ == "__main__":
    main()
