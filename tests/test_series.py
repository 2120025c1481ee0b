"""Blocked features against plain pandas formulas."""

from __future__ import annotations

import datetime as dt
import hashlib
import re

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from daybook.operators import blocks, concat, cuts, metrics, series, stored_series, transforms
from daybook.operators.blocks import Series
from daybook.plans import relations as rel
from daybook.plans.catalogue import QUERIES

SCHEMA = "asset string, date date, close double"


def _history(asset: str, n: int, seed: int, dirty: bool) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    days = np.cumsum(rng.integers(1, 9, n))
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n)))
    if dirty:
        kinds = rng.random(n)
        close = np.where(kinds < 0.03, np.nan, close)
        close = np.where((kinds > 0.97) & (kinds < 0.985), -close, close)
        close = np.where(kinds > 0.99, 0.0, close)
    start = dt.date(1968, 6, 1)
    return pd.DataFrame(
        {"asset": asset, "date": [start + dt.timedelta(int(d)) for d in days], "close": close}
    )


def _expected(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("date").reset_index(drop=True)
    close = group["close"]

    def change(n):
        base = close.shift(n)
        return close / base.where(base != 0) - 1

    out = group.copy()
    out["daily_return"] = change(1)
    growth = (1 + out["daily_return"]).cumprod()
    out["cum_return"] = growth.fillna(1.0)
    out["volatility_30d"] = out["daily_return"].rolling(30).std()
    out["rolling_return_30d"] = change(30)
    out["rolling_return_90d"] = change(90)
    out["rolling_max"] = close.cummax()
    out["drawdown"] = close / out["rolling_max"].where(out["rolling_max"] != 0) - 1
    peak = out["cum_return"].cummax()
    out["growth_drawdown"] = (out["cum_return"] - peak) / peak
    return out


def _frame(spark, data: pd.DataFrame):
    records = [
        (a, d, None if np.isnan(c) else float(c)) for a, d, c in data.itertuples(index=False)
    ]
    return spark.createDataFrame(records, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def data() -> pd.DataFrame:
    sizes = [1, 2, 29, 30, 31, 32, 90, 91, 92, 250, 400, 400]
    parts = [_history(f"a{i}", n, i, dirty=i % 2 == 1) for i, n in enumerate(sizes)]
    parts += [_history(f"d{i}", 300, 100 + i, dirty=True) for i in range(6)]
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="module")
def expected(data) -> pd.DataFrame:
    parts = [_expected(g) for _, g in data.groupby("asset")]
    return pd.concat(parts, ignore_index=True).sort_values(["asset", "date"]).reset_index(drop=True)


def _compare(df, expected: pd.DataFrame, columns: list[str]) -> None:
    got = df.select("asset", "date", *columns).toPandas()
    got = got.sort_values(["asset", "date"]).reset_index(drop=True)
    assert len(got) == len(expected)
    for c in columns:
        np.testing.assert_allclose(
            got[c].astype(float), expected[c].astype(float), rtol=1e-8, atol=1e-9, err_msg=c
        )


@pytest.mark.parametrize("span", [1, 11, 200, None, 100_000])
def test_features_do_not_depend_on_the_block_length(spark, data, expected, span):
    layout = Series(span_days=span)
    out = series.price_features(_frame(spark, data), layout)
    columns = [c for c in expected.columns if c not in ("asset", "date", "growth_drawdown")]
    _compare(out, expected, columns)


@pytest.mark.parametrize("span", [11, None])
def test_single_features(spark, data, expected, span):
    layout, prices = Series(span_days=span), _frame(spark, data)
    _compare(series.daily_return(prices, layout), expected, ["daily_return"])
    _compare(series.rolling_return(prices, series=layout), expected, ["rolling_return_30d", "rolling_return_90d"])
    _compare(series.rolling_volatility(prices, series=layout), expected, ["volatility_30d"])
    _compare(series.cumulative_return(prices, layout), expected, ["cum_return"])
    _compare(series.drawdown_series(prices, series=layout), expected, ["rolling_max", "drawdown"])
    growth = series.drawdown_series(prices, "cum_return", layout).withColumnRenamed("drawdown", "growth_drawdown")
    _compare(growth, expected, ["growth_drawdown"])


def test_rolling_window_of_another_length(spark, data):
    out = series.rolling_volatility(_frame(spark, data), 5, Series(span_days=20))
    parts = [g.sort_values("date") for _, g in data.groupby("asset")]
    expected = pd.concat(
        [_expected(g).assign(volatility_5d=lambda x: x["daily_return"].rolling(5).std()) for g in parts]
    ).sort_values(["asset", "date"])
    _compare(out, expected.reset_index(drop=True), ["volatility_5d"])


def test_metrics(spark, data, expected):
    out = metrics.portfolio_metrics(_frame(spark, data), Series(span_days=50)).orderBy("asset").toPandas()
    groups = expected.groupby("asset")
    np.testing.assert_allclose(out["max_drawdown"], groups["growth_drawdown"].min(), rtol=1e-8)
    np.testing.assert_allclose(
        out["avg_volatility_30d"].astype(float), groups["volatility_30d"].mean(), rtol=1e-8
    )
    chained = metrics.metrics_join_chain(
        *[m(_frame(spark, data)) for m in (metrics.cagr, metrics.max_drawdown, metrics.mean_volatility)]
    )
    pd.testing.assert_frame_equal(chained.orderBy("asset").toPandas(), out, rtol=1e-8)


def _day(n: int) -> dt.date:
    return dt.date(2020, 1, 1) + dt.timedelta(n)


def _closes(spark, closes, asset="x"):
    return spark.createDataFrame([(asset, _day(i), c) for i, c in enumerate(closes)], SCHEMA)


def test_volatility_needs_thirty_returns(spark):
    thirty = series.rolling_volatility(_closes(spark, [float(i + 1) for i in range(30)]))
    assert thirty.where("volatility_30d IS NOT NULL").count() == 0
    more = series.rolling_volatility(_closes(spark, [float(i + 1) for i in range(31)]))
    assert rows(more.where("volatility_30d IS NOT NULL").select("date")) == [(_day(30),)]


def test_one_close(spark):
    prices = _closes(spark, [7.0])
    assert rows(series.cumulative_return(prices).select("daily_return", "cum_return")) == [(None, 1.0)]
    assert rows(metrics.portfolio_metrics(prices)) == [("x", None, 0.0, None)]


def test_gap_restarts_at_one_and_the_product_goes_on(spark):
    out = series.cumulative_return(_closes(spark, [10.0, 20.0, None, 40.0, 80.0])).orderBy("date")
    assert rows(out.select("daily_return", "cum_return")) == [
        (None, 1.0),
        (1.0, 2.0),
        (None, 1.0),
        (None, 1.0),
        (1.0, 4.0),
    ]


def test_zero_close_gives_null_not_an_error(spark):
    out = series.daily_return(_closes(spark, [10.0, 0.0, 5.0])).orderBy("date")
    assert rows(out.select("daily_return")) == [(None,), (-1.0,), (None,)]


def test_growth_uses_calendar_days_of_365(spark):
    prices = spark.createDataFrame([("x", _day(0), 100.0), ("x", _day(730), 121.0)], SCHEMA)
    [(_, value)] = rows(metrics.cagr(prices))
    assert value == pytest.approx(0.1)


def test_summary_takes_the_last_value_present(spark):
    features = spark.createDataFrame(
        [("x", _day(0), 1.0, 0.2, -0.1, 0.5, None), ("x", _day(1), 2.0, None, -0.3, None, None)],
        "asset string, date date, cum_return double, volatility_30d double, drawdown double,"
        " rolling_return_30d double, rolling_return_90d double",
    )
    assert rows(metrics.asset_summary(features)) == [("x", 2.0, 0.2, -0.3, 0.5, None)]


def test_own_metric_sees_blocks_in_order(spark, data):
    layout = Series(span_days=30)

    def partial(part):
        assert list(part["date"]) == sorted(part["date"])
        return {"rows": len(part), "first": part["date"].iloc[0]}

    def finish(states):
        assert list(states["first"]) == sorted(states["first"])
        return {"n": int(states["rows"].sum())}

    out = metrics.group_metric_apply(
        _frame(spark, data), partial, "rows bigint, first date", finish, "n bigint", layout
    )
    assert dict(rows(out)) == data.groupby("asset").size().to_dict()


def test_timestamps_as_order_column(spark):
    ticks = spark.range(5000).select(
        F.lit("x").alias("asset"),
        F.timestamp_seconds(F.col("id") * 600).alias("date"),
        (F.col("id") + 1).cast("double").alias("close"),
    )
    out = series.rolling_return(ticks, [90], Series(span_days=1))
    wrong = out.where(
        "NOT (rolling_return_90d <=> IF(close > 90, close / (close - 90) - 1, NULL))"
    )
    assert out.count() == 5000 and wrong.count() == 0


def test_a_hot_series_is_spread_over_blocks(spark):
    """One series with most rows: no window partition holds more than a block and its lead-in."""
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("asset"),
        F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit(1.0).alias("close"),
    )
    layout = Series(span_days=1000)
    sizes = blocks.with_lead_in(hot, layout, 90).groupBy(*layout.block_keys).count()
    assert sizes.agg(F.max("count")).head()[0] <= 1000 + 90
    assert sizes.count() == 40


def test_rows_without_key_or_date_are_left_out(spark):
    prices = spark.createDataFrame([("x", _day(0), 1.0), (None, _day(1), 2.0), ("x", None, 3.0)], SCHEMA)
    assert rows(series.daily_return(prices)) == [("x", _day(0), 1.0, None)]


def test_repeated_days_are_ordered_by_value(spark):
    closes = [(0, 1.0), (1, 8.0), (1, 2.0), (1, 4.0), (2, 16.0), (2, 16.0)]
    prices = spark.createDataFrame([("x", _day(d), c) for d, c in closes], SCHEMA).repartition(4)
    out = series.cumulative_return(prices).orderBy("date", "close", "cum_return")
    assert rows(out.select("close", "cum_return")) == [(c, c) for c in (1.0, 2.0, 4.0, 8.0, 16.0, 16.0)]


EDGE = [("1970-01-29", 4.0), ("1970-01-30", 9.0), ("1970-01-30", 5.0), ("1970-01-31", 18.0), ("1970-01-31", 3.0), ("1970-03-01", 6.0)]


@pytest.mark.parametrize("feature", ["daily_return", "cumulative_return", "drawdown_series"])
def test_repeated_positions_at_block_edges(spark, feature):
    results = set()
    for span in (1, 30, 100_000):
        for given in (EDGE, EDGE[::-1]):
            df = spark.createDataFrame(given, "date string, close double").selectExpr("'x' AS asset", "date(date) AS date", "close")
            out = getattr(series, feature)(df.repartition(3), series=Series(span_days=span))
            rounded = (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in out.collect())
            results.add(tuple(sorted(map(str, rounded))))
    assert len(results) == 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_blocks_of_ten_minutes(spark, kind):
    df = spark.range(500).selectExpr(
        "'x' AS asset", f"CAST(timestamp '2024-03-31 00:00:00' + make_dt_interval(0, 0, 0, id * 37) AS {kind}) AS at", "double(1 + id * 7 % 11) AS close"
    )
    both = [
        sorted(map(str, (tuple(r) for r in series.daily_return(df, Series(order="at", span_seconds=s)).collect())))
        for s in (600, 10_000_000)
    ]
    assert both[0] == both[1] and len(both[0]) == 500


def test_drawdown_alone_needs_one_row_before_a_block(spark, small):
    plan = metrics.max_drawdown(rel.prices(spark, small))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan


# Blocks cut by rows


def _ticks(spark, n=6000):
    """Half of all rows on one day of one asset, values repeated, some missing."""
    return spark.range(n).selectExpr(
        "IF(id % 4 < 3, 'hot', 'cold' || id % 3) AS asset",
        "date_add(date'2000-01-01', IF(id % 2 = 0, 700, CAST(id % 1500 AS INT))) AS date",
        "IF(id % 97 = 0, NULL, 1 + pmod(xxhash64(id), 900) / 100.0D) AS close",
        "id",
    ).repartition(6)


@pytest.mark.parametrize("ties", [(), ("id",)])
def test_blocks_by_rows_give_the_same_features(spark, ties):
    ticks = _ticks(spark)
    whole = series.price_features(ticks, Series(span_days=100_000, ties=("id",)))
    cut = series.price_features(ticks, Series(block_rows=150, ties=("id",)))
    for one, other in zip(whole.orderBy("id").collect(), cut.orderBy("id").collect(), strict=True):
        for a, b in zip(one, other, strict=True):
            assert a == b or a == pytest.approx(b, rel=1e-9, abs=1e-12)
    lows = [metrics.max_drawdown(ticks, Series(ties=ties, **kind)).orderBy("asset").toPandas() for kind in ({"block_rows": 150}, {"span_days": 100_000})]
    pd.testing.assert_frame_equal(*lows, rtol=1e-9)


def test_a_hot_day_is_spread_over_blocks(spark):
    layout = Series(block_rows=150, ties=("id",))
    sizes = blocks.with_block(_ticks(spark), layout).groupBy(*layout.block_keys).count().toPandas()["count"]
    assert sizes.sum() == 6000 and len(sizes) > 30
    assert sizes.max() <= 2 * 150


def test_cuts_order_null_first_and_keep_equal_rows_together(spark):
    rows_ = [(k, None if v % 5 == 0 else v % 40, t) for k in ("a", "b", None) for v in range(300) for t in "xy"]
    df = spark.createDataFrame(rows_, "k string, v int, t string")
    for keys in (["k"], []):
        placed = cuts.sampled_cuts(df, keys, ["v", "t"], 50).place(df, "block").toPandas()
        for _, group in placed.groupby(keys or (lambda _: 0), dropna=True):
            ordered = group.assign(v=group["v"].fillna(-1)).sort_values(["v", "t"])
            assert ordered["block"].is_monotonic_increasing
            assert (ordered.groupby(["v", "t"])["block"].nunique() == 1).all()
            assert ordered["block"].nunique() > 2
    assert cuts.sampled_cuts(df, ["k"], ["v"], 10_000).table is None
    assert cuts.sampled_cuts(df.limit(0), ["k"], ["v"], 10).place(df, "block").agg(F.max("block")).head()[0] == 0


@pytest.mark.parametrize("n", [2, 7, 250])
def test_lead_in_is_exactly_the_rows_before_a_block(spark, data, n):
    layout = Series(span_days=23)
    led = blocks.with_lead_in(_frame(spark, data), layout, n).toPandas()
    history = {a: list(g.sort_values("date")["date"]) for a, g in data.groupby("asset")}
    for (asset, _), block in led.groupby(["asset", "_block"]):
        own = block[~block["_lead_in"]]["date"].min()
        place = history[asset].index(own)
        assert sorted(block[block["_lead_in"]]["date"]) == history[asset][max(0, place - n) : place]


def test_one_row_windows_and_long_ones(spark, data):
    out = series.rolling_volatility(_frame(spark, data), 1, Series(span_days=20))
    assert out.where("volatility_1d IS NOT NULL").count() == 0
    longer = series.rolling_volatility(_frame(spark, data), 120, Series(span_days=20))
    parts = [_expected(g).assign(volatility_120d=lambda x: x["daily_return"].rolling(120).std()) for _, g in data.groupby("asset")]
    expected = pd.concat(parts).sort_values(["asset", "date"]).reset_index(drop=True)
    _compare(longer, expected, ["volatility_120d"])


def test_a_far_value_does_not_blur_later_windows(spark):
    closes = [1.0, 1e9, 1.0] + [1.0 + (i % 7) / 1000 for i in range(60)]
    out = series.rolling_volatility(_closes(spark, closes), 5).orderBy("date").toPandas()
    expected = pd.Series(closes).pct_change().rolling(5).apply(lambda w: np.std(w, ddof=1), raw=True)
    np.testing.assert_allclose(out["volatility_5d"].astype(float)[10:], expected[10:], rtol=1e-12)


# Drawdown from block states


def test_drawdown_moves_the_rows_once_and_windows_none(spark, small, tmp_path):
    path = str(tmp_path / "prices")
    rel.prices(spark, small).write.parquet(path)
    plan = metrics.max_drawdown(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    rows_moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_block" in line]
    assert len(rows_moved) == 1 and "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert plan.index("Window") < plan.index("ObjectHashAggregate")  # above it: over block states alone


@pytest.mark.parametrize("closes", [
    [1.0], [None], [None, None, 3.0], [0.0, 0.0], [5.0, -5.0, 10.0, -1.0, -2.0, 4.0], [1.0, 0.0, 2.0, 1.0],
    [-1.0, -2.0, -0.5, None, -4.0, -1.0], [2.0, None, 1.0, 4.0, 1.0, -3.0, None, 8.0, 8.0, 2.0],
])
@pytest.mark.parametrize("span", [1, 3, 1000])
def test_drawdown_of_odd_series(spark, closes, span):
    data = pd.DataFrame({"asset": "x", "date": [_day(i) for i in range(len(closes))], "close": np.array(closes, dtype=float)})
    [(_, low)] = rows(metrics.max_drawdown(_frame(spark, data), Series(span_days=span)))
    assert low == pytest.approx(_expected(data)["growth_drawdown"].min(), rel=1e-9, abs=1e-12)


# Transforms of the caller's own, stored series, ordered strings


@pytest.mark.parametrize("layout", [Series(span_days=1), Series(span_days=40), Series(), Series(block_rows=90)])
def test_exponential_mean_does_not_depend_on_blocks(spark, data, layout):
    out = transforms.exponential_mean(_frame(spark, data), 9, layout)
    parts = []
    for _, g in data.groupby("asset"):
        g = g.sort_values("date")
        parts.append(g.assign(ewm=g["close"].dropna().ewm(span=9, adjust=False).mean().reindex(g.index).ffill()))
    expected = pd.concat(parts).sort_values(["asset", "date"]).reset_index(drop=True)
    _compare(out, expected, ["ewm"])


def test_stored_features_equal_clipping_after(spark, data, tmp_path):
    layout, prices = Series(span_days=50), _frame(spark, data)
    stored_series.store_series(prices, str(tmp_path), layout)
    out = stored_series.stored_features(spark, str(tmp_path), prices, "1969-08-01", "1970-02-10", layout)
    columns = ["asset", "date", "close", "daily_return", "cum_return", "volatility_30d", "rolling_return_30d", "rolling_return_90d", "rolling_max", "drawdown"]
    clipped = series.price_features(prices, layout).where("date >= '1969-08-01' AND date < '1970-02-10'")
    ours, theirs = (df.select(columns).orderBy("asset", "date").toPandas() for df in (out, clipped))
    assert len(ours) > 50
    pd.testing.assert_frame_equal(ours, theirs, rtol=1e-9)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(_block") == 2
    with pytest.raises(ValueError, match="stretches of time"):
        stored_series.store_series(prices, str(tmp_path / "x"), Series(block_rows=5))


def test_ordered_strings_do_not_depend_on_ranges(spark):
    texts = [(k, None if i % 11 == 0 else f"t{i % 50:02d}" + "é" * (i % 3), 1 + i % 3) for k in ("a", "b") for i in range(200)] + [("c", None, 2)]
    counted = spark.createDataFrame(texts, "k string, text string, copies int")
    expected = {k: " | ".join(sorted(t for kk, t, n in texts if kk == k and t for _ in range(n))) or None for k in "abc"}
    for size in (7, 100_000):
        assert dict(rows(concat.joined_in_order(counted, ["k"], "text", "copies", " | ", size))) == expected


def test_strings_in_pieces_give_the_digest_of_the_whole(spark, tmp_path):
    """Texts longer than a piece, characters of several bytes, many copies, keys and texts that are NULL."""
    texts = [(k, None if i % 11 == 0 else f"t{i % 50:02d}" + "é☃" * (i % 40), 1 + i % 3) for k in ("a", None) for i in range(200)]
    texts += [("b", None, 2), ("c", "", 1), ("d", "", 3), ("d", None, 1), ("e", "x" * 1_000, 500)]
    counted = spark.createDataFrame(texts, "k string, text string, copies int")
    joined = {k: " | ".join(sorted(t for kk, t, n in texts if kk == k and t is not None for _ in range(n))) for k, _, _ in texts}
    expected = {k: (len(t), hashlib.md5(t.encode()).hexdigest()) for k, t in joined.items()} | {"b": (None, None)}
    for size in (7, 100_000):
        for most in (64, 1 << 20):
            pieces = concat.joined_in_order(counted, ["k"], "text", "copies", " | ", size, piece_bytes=most)
            assert pieces.agg(F.max("_size")).first()[0] <= most
            assert {k: (n, digest) for k, n, digest in rows(concat.digests_in_order(pieces, ["k"], " | "))} == expected


def test_titles_of_a_language_are_not_put_together_in_a_task(spark, tmp_path):
    """One title, copied beyond what a string can hold, gives its length and MD5."""
    title, copies = "é" * 50_000, 21_500
    one = spark.createDataFrame([("en", title, copies)], "k string, text string, copies long")
    [(_, n, digest)] = rows(concat.digests_in_order(concat.joined_in_order(one, ["k"], "text", "copies", " | ", 200, piece_bytes=1 << 20), ["k"], " | "))
    state = hashlib.md5((title).encode())
    for _ in range(copies - 1):
        state.update((" | " + title).encode())
    assert (n, digest) == (copies * 50_003 - 3, state.hexdigest()) and copies * 100_003 > 1 << 31
    spark.createDataFrame([("en", "b"), ("en", "a"), ("en", "b"), (None, "c")], "lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = QUERIES["ordered_titles"](spark, str(tmp_path))
    expected = {("en", 9, hashlib.md5(b"a | b | b").hexdigest()), (None, 1, hashlib.md5(b"c").hexdigest())}
    assert set(rows(out)) == expected
    assert not re.search("listagg|collect_list|array_join", out._jdf.queryExecution().executedPlan().toString())


def test_tasks_of_sampled_blocks_have_a_bounded_number_of_rows(spark, monkeypatch):
    """Rows that compress to nearly nothing are not merged into a few large tasks."""
    monkeypatch.setattr(cuts, "TASK_ROWS", 5_000)
    rows = spark.range(200_000).selectExpr("'a' AS asset", "DATE '2020-01-01' AS date", "CAST(id % 1000 AS DOUBLE) AS close", "id % 7 AS tie")
    led = blocks.with_lead_in(rows, Series(block_rows=500, ties=("tie",)), 3)
    sizes = [len(part) for part in led.select("close").rdd.glom().collect()]
    assert len(sizes) == 40 and sum(sizes) >= 200_000 and max(sizes) < 15_000
