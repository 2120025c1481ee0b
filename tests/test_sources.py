from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from daybook.operators import ranges
from daybook.sinks import export_tables, overwrite_files, overwrite_table, write_csv
from daybook.snapshots import Snapshots
from daybook.sources import elements, feeds, files, prices, sentiment


def _item(title="T", date="D", source=None, link=None):
    parts = [("title", title), ("pubDate", date), ("source", source), ("link", link)]
    return "<item>" + "".join(f"<{k}>{v}</{k}>" for k, v in parts if v is not None) + "</item>"


def _feed(*items):
    return "<rss><channel><title>feed</title>" + "".join(items) + "</channel></rss>"


def _documents(spark, *texts):
    return spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "event_date string, feed string")


def test_feed_keeps_document_order_and_optional_children(spark):
    docs = _documents(spark, _feed(_item("B", source="S", link="L"), _item("A")))
    assert rows(feeds.feed_items(docs)) == [("d0", 0, "B", "D", "S", "L"), ("d0", 1, "A", "D", None, None)]


def test_feed_keeps_the_first_three(spark):
    docs = _documents(spark, _feed(*[_item(t) for t in "EDCBA"]))
    assert [r[2] for r in rows(feeds.feed_items(docs))] == ["E", "D", "C"]
    assert rows(feeds.feed_item_counts(docs)) == [("d0", 5, 3)]


def test_empty_and_malformed_feeds(spark):
    docs = _documents(spark, "<rss><channel/></rss>", "<rss><chan", _feed(_item("ok")))
    assert [r[2] for r in rows(feeds.feed_items(docs))] == ["ok"]
    assert rows(feeds.malformed_feeds(docs)) == [("d1",)]
    assert rows(feeds.feed_item_counts(docs)) == [("d0", 0, 0), ("d2", 1, 1)]


@pytest.mark.parametrize("bad", [_item(title=None), _item(date=None)])
def test_feed_is_given_up_at_the_first_incomplete_item(spark, bad):
    docs = _documents(spark, _feed(_item("first"), bad, _item("third")), _feed(bad, _item("second")))
    assert [r[2] for r in rows(feeds.feed_items(docs))] == ["first"]


def test_feed_text_is_taken_as_it_is(spark):
    docs = _documents(
        spark,
        _feed('<item><title> a &amp; b <![CDATA[<c>]]></title><pubDate/><source url="u">S</source></item>'),
        "<feed>" + _item("under the root") + "</feed>",
    )
    assert rows(feeds.feed_items(docs)) == [
        ("d0", 0, " a & b <c>", "", "S", None),
        ("d1", 0, "under the root", "D", None, None),
    ]


def test_landed_feeds(spark, tmp_path):
    for day, title in (("2020-03-12", "x"), ("2020-03-13", "y")):
        folder = tmp_path / f"event_date={day}"
        folder.mkdir()
        (folder / "feed.xml").write_text(_feed(_item(title)))
    out = feeds.feed_items(feeds.landed_feeds(spark, str(tmp_path)))
    assert sorted((r[0], r[2]) for r in rows(out)) == [("2020-03-12", "x"), ("2020-03-13", "y")]


def _payload(*entries):
    names = ("value", "value_classification", "timestamp")
    return json.dumps({"name": "x", "data": [dict(zip(names, e)) for e in entries]})


def test_sentiment_payload(spark, tmp_path):
    (tmp_path / "a.json").write_text(_payload(("26", "Fear", "1577836800"), ("74", "Greed", "1577923200")))
    out = sentiment.sentiment_days(sentiment.landed_payloads(spark, str(tmp_path))).orderBy("date")
    assert rows(out) == [(dt.datetime(2020, 1, 1), 26, "Fear"), (dt.datetime(2020, 1, 2), 74, "Greed")]


def test_sentiment_time_is_utc_in_any_session(spark):
    docs = spark.createDataFrame([(_payload(("26", "Fear", "1577836800")),)], "payload string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert rows(sentiment.sentiment_days(docs).selectExpr("string(date)")) == [("2020-01-01 00:00:00",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text", ["{}", "not json"])
def test_payload_without_data_is_an_error(spark, text):
    docs = spark.createDataFrame([(text,)], "payload string")
    with pytest.raises(Exception, match="without data|MALFORMED"):
        sentiment.sentiment_days(docs).collect()


def test_payload_with_no_days(spark):
    docs = spark.createDataFrame([('{"data": []}',)], "payload string")
    assert rows(sentiment.sentiment_days(docs)) == []


def test_sentiment_clip_includes_both_ends(spark):
    days = spark.sql("SELECT explode(sequence(0, 4)) AS n").selectExpr(
        "timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(n) AS date"
    )
    kept = ranges.between_dates(days, "date", "2020-01-02", "2020-01-04")
    assert [r[0].day for r in rows(kept.orderBy("date"))] == [2, 3, 4]
    half_open = ranges.history_window(days, "date", "2020-01-02", "2020-01-04")
    assert [r[0].day for r in rows(half_open.orderBy("date"))] == [2, 3]


def test_landed_prices_take_the_asset_from_the_folder(spark, tmp_path):
    head = "Date,Open,High,Low,Close,Volume\n"
    for asset, close in (("0700", "1.5"), ("BTC-USD", "NaN")):
        folder = tmp_path / f"asset={asset}"
        folder.mkdir()
        (folder / "part.csv").write_text(head + f"2020-01-01,1,2,0.5,{close},10\n")
    out = prices.landed_prices(spark, str(tmp_path))
    assert sorted(rows(out), key=lambda r: r[2]) == [
        (dt.date(2020, 1, 1), 1.5, "0700"),
        (dt.date(2020, 1, 1), None, "BTC-USD"),
    ]
    one = prices.landed_volatility(spark, str(tmp_path / "asset=0700"))
    assert rows(one) == [(dt.date(2020, 1, 1), 1.5)] and one.columns == ["date", "vix_close"]


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    texts = ["plain", 'a "quoted" one', "line\nbreak", " spaces ", "", None, "a,b", "\\", 'ends with "', "é | 價格"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    write_csv(df, str(tmp_path / "t"))
    back = files.read_csv(spark, str(tmp_path / "t"), df.schema, multi_line=True)
    assert sorted(rows(back)) == sorted(rows(df))


def test_csv_round_trip_of_times_and_numbers(spark, tmp_path):
    df = spark.sql(
        "SELECT timestamp_ntz '2020-01-01 01:02:03.000456' AS local, timestamp '2020-01-01 01:02:03.9' AS instant,"
        " date '1969-12-31' AS day, 0.1D + 0.2D AS x, cast(null AS double) AS missing, 9223372036854775807 AS n"
    )
    write_csv(df, str(tmp_path / "t"))
    assert rows(files.read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)


def test_csv_types_can_be_inferred(spark, tmp_path):
    (tmp_path / "t.csv").write_text("date,n,x,s\n2020-01-01,1,1.5,a\n")
    out = files.read_csv(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in out.dtypes] == ["date", "int", "double", "string"]


def _land(tmp_path, asset, text):
    folder = tmp_path / f"asset={asset}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "t.csv").write_text(text)
    return str(tmp_path)


def test_quotes_without_a_needed_column_are_refused(spark, tmp_path):
    path = _land(tmp_path, "x", "Date,Close\n2020-01-01,1\n")
    with pytest.raises(Exception):
        prices.landed_prices(spark, path).collect()


def test_quote_columns_are_taken_by_name(spark, tmp_path):
    path = _land(tmp_path, "x", "Close,Date,Adj,High,Low,Open,Volume\n7,2020-01-01,9,2,0.5,1,10\n")
    assert rows(prices.landed_prices(spark, path)) == [(dt.date(2020, 1, 1), 7.0, "x")]


HEAD = "Date,Open,High,Low,Close,Volume\n"


@pytest.mark.parametrize("bad", ["02/01/2020,1,1,1,1,1", ",1,1,1,1,1", "2020-01-02,1,1,1,n/a,1"])
def test_bad_quotes_are_an_error_and_can_be_listed(spark, tmp_path, bad):
    path = _land(tmp_path, "x", HEAD + "2020-01-01,1,1,1,1,1\n" + bad + "\n2020-01-03,1,1,1,2,1\n")
    with pytest.raises(Exception, match="bad quote"):
        prices.landed_prices(spark, path).collect()
    listed = rows(prices.malformed_quotes(spark, path))
    assert [tuple(v or "" for v in r[1:]) for r in listed] == [tuple(bad.split(","))]


def test_dates_with_a_time_are_read(spark, tmp_path):
    path = _land(tmp_path, "x", HEAD + "2020-01-01 00:00:00,1,1,1,5,1\n")
    assert rows(prices.landed_prices(spark, path)) == [(dt.date(2020, 1, 1), 5.0, "x")]


@pytest.mark.parametrize("entry", [("5", "Fear", None), (None, "Fear", "1577836800"), ("x", "Fear", "1577836800")])
def test_sentiment_elements_without_time_or_value_are_an_error(spark, entry):
    docs = spark.createDataFrame([(_payload(entry),)], "payload string")
    with pytest.raises(Exception, match="sentiment element"):
        sentiment.sentiment_days(docs).collect()


def test_feed_items_of_several_places(spark):
    two = "<rss><channel>" + _item("a") + "</channel><channel>" + _item("b") + "</channel></rss>"
    both = "<rss><channel>" + _item("c") + "</channel>" + _item("d") + "</rss>"
    twice = _feed("<item><title>first</title><title>second</title><pubDate>p</pubDate></item>")
    deeper = "<rss><channel><group>" + _item("lost") + "</group></channel></rss>"
    docs = _documents(spark, two, both, twice, deeper)
    found = sorted((r[0], r[1], r[2]) for r in rows(feeds.feed_items(docs)))
    assert found == [("d0", 0, "a"), ("d0", 1, "b"), ("d1", 0, "c"), ("d1", 1, "d"), ("d2", 0, "first")]
    assert rows(feeds.malformed_feeds(docs)) == [("d3",)]


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_files(spark.range(5).toDF("n"), path)
    with pytest.raises(Exception):
        overwrite_files(spark.sql("SELECT raise_error('no') AS n"), path)
    assert spark.read.parquet(path).count() == 5
    kept = spark.read.parquet(path).where("n < 2")
    assert overwrite_files(kept, path).count() == 2


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_files(spark.range(5).toDF("n"), path)
    assert overwrite_files(spark.range(3).toDF("n"), path).count() == 3
    for n in (5, 3):
        table = overwrite_table(spark.range(n).toDF("n"), "replaced", str(tmp_path / "named"))
    assert table.count() == 3
    spark.sql("DROP TABLE replaced")


def test_export_counts_rows_while_writing(spark, tmp_path):
    tables = {"a": spark.range(7).toDF("n"), "b": spark.sql("SELECT 1 AS x, 2 AS y WHERE false")}
    out = export_tables(spark, tables, str(tmp_path))
    assert sorted(rows(out)) == [("a", 7, 1), ("b", 0, 2)]
    assert files.read_csv(spark, f"{tmp_path}/a_export.csv").count() == 7


# Feeds that break off, and files read by element


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (_feed(_item("a"), _item("b"))[:-9], ["a", "b"]),  # inside the closing tags
        ("<rss><channel>" + _item("a") + _item("b")[:-3], ["a"]),
        ("<rss><channel>" + _item("a") + "<item><title>b", ["a"]),
        (_feed(_item("a"), "<item><title>&bad;</title><pubDate>D</pubDate></item>", _item("c")), ["a"]),
        (_feed(_item("a"), "<item><title>x</b></title></item>", _item("c")), ["a"]),
        ("<rss><channel><title>no items", []),
        ("", []),
        (_feed(_item("a"), _item(date=None), _item("c"))[:-6], ["a"]),
    ],
)
def test_broken_feeds_keep_the_items_before_the_break(spark, text, kept):
    docs = _documents(spark, text, _feed(_item("other")))
    out = rows(feeds.feed_items(docs).orderBy("event_date", "position"))
    assert [(r[1], r[2]) for r in out if r[0] == "d0"] == list(enumerate(kept))
    assert [r[2] for r in out if r[0] == "d1"] == ["other"]
    if text:
        assert rows(feeds.malformed_feeds(docs)) == [("d0",)]


@pytest.fixture
def small_splits(spark):
    """Files are cut into many small splits."""
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
    spark.conf.set("spark.sql.files.openCostInBytes", kept[1])


def _land_feed(folder, day, text, name="f.xml"):
    place = folder / f"event_date={day}"
    place.mkdir(parents=True, exist_ok=True)
    (place / name).write_text(text)


def test_a_large_feed_is_read_by_many_tasks(spark, tmp_path, small_splits):
    many = [_item(f"t{i} ž &amp; <![CDATA[<b>]]>", source=None if i % 3 else "S", link="l" * (i % 50)) for i in range(1500)]
    _land_feed(tmp_path, "d0", _feed(*many))
    _land_feed(tmp_path, "d1", _feed(*many[:40], _item(date=None), *many[40:]))
    _land_feed(tmp_path, "d2", _feed(*many[:10])[:-40])
    _land_feed(tmp_path, "d3", "<rss><channel/></rss>")
    _land_feed(tmp_path, "d4", _feed(_item("first")), "a.xml")
    _land_feed(tmp_path, "d4", _feed(_item("of another file")), "b.xml")
    by_item = elements.landed_feed_items(spark, str(tmp_path), n=1000)
    whole = feeds.feed_items(feeds.landed_feeds(spark, str(tmp_path), with_file=True), n=1000)
    assert sorted(rows(by_item.select(whole.columns)), key=str) == sorted(rows(whole), key=str)
    assert by_item.count() == 1000 + 40 + 9 + 2
    assert elements._elements(spark, str(tmp_path / "event_date=d0"), elements.ITEM_END, []).rdd.getNumPartitions() > 20


def test_a_large_payload_is_read_by_many_tasks(spark, tmp_path, small_splits):
    def day(i):
        return {"value": str(i % 100), "value_classification": "Fear, [so]", "timestamp": str(i * 86400)}

    for name, days in (("a", range(2000)), ("b", range(5000, 5003)), ("c", [])):
        (tmp_path / f"{name}.json").write_text(json.dumps({"name": "x", "data": [day(i) for i in days], "metadata": {"error": None}}, indent=1 if name == "b" else None))
    by_element = elements.landed_sentiment_days(spark, str(tmp_path))
    whole = sentiment.sentiment_days(sentiment.landed_payloads(spark, str(tmp_path)))
    assert sorted(rows(by_element)) == sorted(rows(whole)) and by_element.count() == 2003


@pytest.mark.parametrize(
    "text",
    ['{"name": "x"}', '{"data": [{"value": "1"}]}', '{"data": [{"value": "a", "timestamp": "1"}]}', '{"data": [{"value": "1", "value_classification": "{x}", "timestamp": "1"}]}'],
)
def test_bad_payload_elements_are_an_error(spark, tmp_path, text):
    (tmp_path / "p.json").write_text(text)
    with pytest.raises(Exception, match="sentiment|MALFORMED|malformed"):
        elements.landed_sentiment_days(spark, str(tmp_path)).collect()


def test_bad_quotes_are_an_error_without_the_date(spark, tmp_path):
    folder = tmp_path / "asset=X"
    folder.mkdir()
    (folder / "q.csv").write_text("Date,Open,High,Low,Close,Volume\n2020-01-01,1,1,1,1,1\n2020-01-02,1,1,1,n/a,1\n")
    quotes = prices.landed_quotes(spark, str(tmp_path))
    with pytest.raises(Exception, match="bad quote"):
        quotes.groupBy("asset").avg("Close").collect()
    assert quotes.groupBy("asset").avg("Open").collect()[0][1] == 1.0


# Snapshots


def test_tables_of_a_version_change_together(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    with pytest.raises(LookupError):
        snapshots.tables()
    names = [f"t{i}" for i in range(5)]
    with snapshots.draft() as draft:
        for name in names:
            draft.write(name, spark.range(1).toDF(name))
    reader = snapshots.tables()
    with pytest.raises(RuntimeError, match="last"), snapshots.draft() as draft:
        for name in names[:-1]:
            draft.write(name, spark.range(7).toDF(name))
        raise RuntimeError("last of five")
    assert [snapshots.tables()[n].count() for n in names] == [1] * 5
    with snapshots.draft() as draft:
        draft.write("t0", spark.range(3).toDF("t0"))
        assert snapshots.tables()["t0"].count() == 1
    assert [snapshots.tables()[n].count() for n in names] == [3, 1, 1, 1, 1]
    assert [reader[n].count() for n in names] == [1] * 5
    assert snapshots.tables(1)["t0"].count() == 1


def test_only_the_faster_of_two_drafts_is_published(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    first, second = snapshots.draft(), snapshots.draft()
    for n, draft in enumerate((first, second)):
        draft.write("t", spark.range(n + 1))
    second.publish()
    with pytest.raises(FileExistsError):
        first.publish()
    assert snapshots.tables()["t"].count() == 2
    with pytest.raises(ValueError, match="table name"):
        snapshots.draft().write("a/b", spark.range(1))


def test_expired_versions_go_with_the_tables_only_they_name(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    for n in range(4):
        with snapshots.draft() as draft:
            draft.write("new", spark.range(n))
            if n == 0:
                draft.write("kept", spark.range(9))
    snapshots.expire(2)
    assert snapshots.versions() == [3, 4]
    assert [snapshots.tables(v)["new"].count() for v in (3, 4)] == [2, 3]
    assert snapshots.tables()["kept"].count() == 9
    assert len(list((tmp_path / "_versions").glob("*/new"))) == 2


def test_a_catalog_table_changes_in_one_step(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in (2, 3, 4):
        table = overwrite_table(spark.range(n).toDF("n"), "stepped", root)
        assert table.count() == n == spark.table("stepped").count()
    before = spark.table("stepped")
    with pytest.raises(Exception, match="lost"):
        overwrite_table(spark.range(1).selectExpr("raise_error('lost') AS x", "id AS n").select(F.coalesce("n", F.col("x").cast("long")).alias("n")).where("x IS NULL"), "stepped", root)
    assert spark.table("stepped").count() == 4 == before.count()
    grown = overwrite_table(spark.table("stepped").selectExpr("n + 1 AS n"), "stepped", root)
    assert sorted(r[0] for r in grown.collect()) == [1, 2, 3, 4]
    with pytest.raises(ValueError, match="other columns"):
        overwrite_table(spark.range(1).toDF("m"), "stepped", root)
    spark.sql("DROP TABLE stepped")
