from __future__ import annotations

import datetime as dt

from conftest import rows

from daybook.operators import news

EVENT = "date date, year int, rank int"
ITEM = "event_date string, position int, title string, pub_date string, source string, link string"


def _events(spark, *days):
    return spark.createDataFrame([(d, d.year, i + 1) for i, d in enumerate(days)], EVENT)


def _items(spark, *records):
    return spark.createDataFrame([(d, i, t, "p", s, None) for i, (d, t, s) in enumerate(records)], ITEM)


A, B = dt.date(2020, 3, 12), dt.date(2021, 1, 1)


def test_request_covers_the_day_before_to_the_day_after(spark):
    [(event, after, before, url)] = rows(news.news_request_plan(_events(spark, B)))
    assert (event, after, before) == ("2021-01-01", "2020-12-31", "2021-01-02")
    assert "after:2020-12-31+before:2021-01-02&" in url


def test_titles_and_sources_are_sorted_apart(spark):
    items = _items(spark, ("2020-03-12", "b", "x"), ("2020-03-12", "a", "z"), ("2020-03-12", "c", "y"))
    [row] = news.enrich_events(_events(spark, A), items).collect()
    assert (row["news_titles"], row["news_sources"]) == ("a | b | c", "x | y | z")


def test_copies_stay_and_missing_sources_are_skipped(spark):
    items = _items(spark, ("2020-03-12", "a", None), ("2020-03-12", "a", "s"), ("2020-03-12", "a", None))
    [row] = news.enrich_events(_events(spark, A), items).collect()
    assert (row["news_titles"], row["news_sources"]) == ("a | a | a", "s")


def test_event_without_items_keeps_its_row(spark):
    items = _items(spark, ("2020-03-12", "a", None), ("1999-01-01", "other", "s"))
    out = rows(news.enrich_events(_events(spark, A, B), items))
    assert out == [(A, 2020, 1, "a", None), (B, 2021, 2, None, None)]


def test_separator_in_a_title(spark):
    items = _items(spark, ("2020-03-12", "a | b", "s"), ("2020-03-12", "c", "s"))
    [row] = news.enrich_events(_events(spark, A), items).collect()
    assert row["news_titles"] == "a | b | c"
    [row] = news.event_headlines(items).collect()
    assert [h["title"] for h in row["headlines"]] == ["a | b", "c"]


def test_first_items_follow_the_feed_order(spark):
    items = _items(spark, *[("2020-03-12", t, "s") for t in "dcba"], ("2021-01-01", "e", "s"))
    kept = news.first_items(items, 3)
    assert sorted(r[2] for r in rows(kept)) == ["b", "c", "d", "e"]


def test_result_does_not_depend_on_a_broadcast(spark):
    items = _items(spark, ("2020-03-12", "b", "s"), ("2020-03-12", "a", None), ("1999-01-01", "c", "s"))
    events = _events(spark, A, B)
    with_broadcast = rows(news.enrich_events(events, items))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(news.enrich_events(events, items)) == with_broadcast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_only_items_of_event_days_are_aggregated(spark):
    items = _items(spark, ("2020-03-12", "a", "s"), ("2020-03-13", "b", "s"))
    assert [r[2] for r in rows(news.items_of_events(items, _events(spark, A)))] == ["a"]
