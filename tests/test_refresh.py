"""The whole job on files landed from the test tables."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from daybook.plans import refresh as job
from daybook.plans import relations as rel
from daybook.schemas import KEY_EVENTS, PRICES
from daybook.sinks import write_csv
from daybook.snapshots import Snapshots
from daybook.sources.files import read_csv


@pytest.fixture(scope="module")
def landed(spark, small, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landed"))
    write_csv(rel.quotes(spark, small), f"{folder}/quotes", partition_by=["asset"])
    close = F.col("vix_close")
    daily = rel.vix(spark, small).select(
        F.col("date").alias("Date"),
        *[close.alias(c) for c in ("Open", "High", "Low", "Close")],
        F.lit(0).cast("long").alias("Volume"),
    )
    write_csv(daily, f"{folder}/volatility")
    rel.payloads(spark, small).write.option("maxRecordsPerFile", 1).text(f"{folder}/sentiment")
    feeds = (
        rel.items(spark, small)
        .groupBy("event_date")
        .agg(F.array_sort(F.collect_list(F.struct("position", F.regexp_replace("title", "[<>&\n]", " ").alias("title")))).alias("i"))
        .select(
            "event_date",
            F.concat(
                F.lit("<rss><channel>"),
                F.array_join(F.transform("i", lambda i: F.concat(F.lit("<item><title>"), i["title"], F.lit("</title><pubDate>p</pubDate></item>"))), ""),
                F.lit("</channel></rss>"),
            ).alias("feed"),
        )
    )
    feeds.repartition(1).write.partitionBy("event_date").text(f"{folder}/feeds")
    return folder


def test_refresh(spark, small, landed, tmp_path):
    out = str(tmp_path)
    for _ in range(2):  # a second run replaces everything
        counts = job.refresh(
            spark,
            f"{landed}/quotes",
            f"{landed}/volatility",
            f"{landed}/sentiment",
            f"{landed}/feeds",
            out,
            start="1995-01-01",
            end="2002-01-01",
        )
    sizes = {n: r for n, r, _ in rows(counts)}
    assert sizes["prices"] == rel.prices(spark, small).count()
    assert sizes["metrics"] == 5

    expected = rel.key_events_table(spark, small)
    written = spark.read.parquet(f"{out}/key_events")
    assert sorted(rows(written)) == sorted(rows(expected))

    assert written.schema == KEY_EVENTS
    assert spark.read.parquet(f"{out}/prices").schema == PRICES

    merged = read_csv(spark, f"{out}/export/key_events_with_news.csv", multi_line=True)
    assert merged.columns == [*expected.columns, "news_titles", "news_sources"]
    assert merged.count() == expected.count()
    news = spark.read.parquet(f"{out}/key_events_news")
    assert news.groupBy("event_date").count().agg(F.max("count")).head()[0] <= 3
    assert merged.where("news_titles IS NOT NULL").count() == news.select("event_date").distinct().count()


def test_history_end_is_excluded_for_prices_and_included_for_sentiment(spark, landed, tmp_path):
    tables = job.load_tables(
        spark,
        f"{landed}/quotes",
        f"{landed}/volatility",
        f"{landed}/sentiment",
        str(tmp_path),
        start="1996-01-01",
        end="1996-12-31",
    )
    last = {n: str(tables[n].agg(F.max("date")).head()[0])[:10] for n in ("prices", "vix", "fear_greed")}
    assert last["fear_greed"] == "1996-12-31"
    assert last["prices"] < "1996-12-31" and last["vix"] < "1996-12-31"


def test_two_stages_and_two_feeds_of_a_day(spark, small, landed, tmp_path):
    out, feeds = str(tmp_path / "out"), tmp_path / "feeds"
    dates = {"start": "1995-01-01", "end": "2002-01-01"}
    requests = job.refresh_events(spark, f"{landed}/quotes", f"{landed}/volatility", f"{landed}/sentiment", out, **dates)
    days = [r[0] for r in requests.select("event_date").orderBy("event_date").collect()]
    folder = feeds / f"event_date={days[0]}"
    folder.mkdir(parents=True)
    for name in "ab":
        items = "".join(f"<item><title>{name}{i}</title><pubDate>p</pubDate></item>" for i in range(2))
        (folder / f"{name}.xml").write_text(f"<rss><channel>{items}</channel></rss>")
    job.refresh_headlines(spark, str(feeds), out)
    news = spark.read.parquet(f"{out}/key_events_news")
    assert sorted(r["title"] for r in news.collect()) == ["a0", "a1", "b0"]
    unanswered = spark.read.parquet(f"{out}/unanswered_requests")
    assert sorted(r["event_date"] for r in unanswered.collect()) == days[1:]


def test_refresh_into_snapshots(spark, small, landed, tmp_path):
    out = Snapshots(spark, str(tmp_path / "snapshots"))
    sources = [f"{landed}/{name}" for name in ("quotes", "volatility", "sentiment")]
    dates = {"start": "1995-01-01", "end": "2002-01-01"}
    job.refresh(spark, *sources, f"{landed}/feeds", out, **dates)
    assert out.versions() == [1, 2]
    events = out.tables()["key_events"]
    assert sorted(rows(events)) == sorted(rows(rel.key_events_table(spark, small)))
    assert {"key_events_news", "unanswered_requests", "prices"} <= set(out.tables())
    with pytest.raises(Exception):  # noqa: B017
        job.refresh_events(spark, sources[0], str(tmp_path / "nothing landed"), sources[2], out, **dates)
    assert out.versions() == [1, 2] and sorted(rows(out.tables()["key_events"])) == sorted(rows(events))
