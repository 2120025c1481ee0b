from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows

from daybook.operators import anomalies
from daybook.operators.blocks import Series
from daybook.schemas import PRICE_SIGNAL, SENTIMENT_SIGNAL, VOLATILITY_SIGNAL

D = [dt.date(2021, 5, 1) + dt.timedelta(i) for i in range(400)]


def _index(spark, values, column, kind):
    return spark.createDataFrame(list(zip(D, values)), f"date date, {column} {kind}")


def _signals(spark, records):
    return spark.createDataFrame(records, "date date, anomaly_type string, severity double")


def test_sentiment_counts_both_ways_and_is_strict(spark):
    out = anomalies.sentiment_anomaly(_index(spark, [50, 60, 71, 60, 49], "fng_value", "int"))
    assert sorted(rows(out)) == [
        (D[2], SENTIMENT_SIGNAL, 1.1),
        (D[3], SENTIMENT_SIGNAL, 1.1),
        (D[4], SENTIMENT_SIGNAL, 1.1),
    ]


def test_volatility_counts_rises_only_and_is_strict(spark):
    out = anomalies.volatility_anomaly(_index(spark, [10.0, 12.0, 8.4, 12.6], "vix_close", "double"))
    assert [(d, t) for d, t, _ in rows(out)] == [(D[3], VOLATILITY_SIGNAL)]
    assert rows(out)[0][2] == pytest.approx(2.5)


def test_several_indexes_in_one_table(spark):
    records = [(s, d, v) for s, values in (("x", [10, 30]), ("y", [70, 72, 10])) for d, v in zip(D, values)]
    both = spark.createDataFrame(records, "series_id string, date date, fng_value int")
    keyed = Series(keys=("series_id",), value="fng_value", span_days=1)
    out = anomalies.sentiment_anomaly(both, keyed)
    assert sorted((d, s) for d, _, s in rows(out)) == [(D[1], 2.0), (D[2], 6.2)]


def test_change_after_zero_or_missing_is_not_anomalous(spark):
    out = anomalies.volatility_anomaly(_index(spark, [0.0, 5.0, None, 50.0], "vix_close", "double"))
    assert rows(out) == []


def test_price_takes_the_worst_asset_of_a_day(spark):
    calm = [0.01, -0.01] * 20
    records = [("a", D[i], r) for i, r in enumerate([None, *calm, 0.5])]
    records += [("b", D[i], r) for i, r in enumerate([None, *calm, -0.9])]
    returns = spark.createDataFrame(records, "asset string, date date, daily_return double")
    [(day, label, severity)] = rows(anomalies.price_anomaly(returns))
    scores = {r["asset"]: abs(r["zscore"]) for r in anomalies.return_zscore(returns).where(f"date = '{D[41]}'").collect()}
    assert (day, label) == (D[41], PRICE_SIGNAL)
    assert severity == max(scores.values())


def test_asset_without_spread_has_no_anomaly(spark):
    returns = spark.createDataFrame(
        [("a", D[0], 0.1), ("b", D[0], 0.1), ("b", D[1], 0.1)], "asset string, date date, daily_return double"
    )
    assert rows(anomalies.price_anomaly(returns)) == []


def test_score_counts_a_repeated_signal_once_but_adds_it_twice(spark):
    out = anomalies.daily_score(_signals(spark, [(D[0], "b", 1.5), (D[0], "b", 2.5), (D[0], "a", 1.0)]))
    [row] = out.collect()
    assert (row["anomaly_count"], row["severity_score"], row["total_score"]) == (2, 5.0, 9.0)
    assert row["anomaly_types"] == "a + b + b"


def test_a_day_made_of_copies_travels_as_one_row(spark):
    copies = spark.range(20_000).selectExpr("DATE '2021-05-01' AS date", "'b' AS anomaly_type", "0.5D AS severity")
    scores = anomalies.daily_score(copies.unionByName(_signals(spark, [(D[0], "a", 1.0)])))
    [row] = scores.collect()
    assert (row["anomaly_count"], row["severity_score"]) == (2, 10_001.0)
    assert row["anomaly_types"] == "a" + " + b" * 20_000
    plan = scores._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    text = next(line for line in plan.splitlines() if "listagg" in line)
    assert plan.index(text) < plan.index("hashpartitioning(date") < plan.index("partial_count(1)")


def test_signal_names_are_ordered_by_code_point(spark):
    names = [PRICE_SIGNAL, SENTIMENT_SIGNAL, VOLATILITY_SIGNAL]
    [row] = anomalies.daily_score(_signals(spark, [(D[0], n, 1.0) for n in names])).collect()
    assert row["anomaly_types"] == " + ".join([VOLATILITY_SIGNAL, PRICE_SIGNAL, SENTIMENT_SIGNAL])


def test_missing_signal_name_is_neither_counted_nor_named(spark):
    [row] = anomalies.daily_score(_signals(spark, [(D[0], None, 1.0)])).collect()
    assert (row["anomaly_count"], row["anomaly_types"], row["severity_score"]) == (0, None, 1.0)


def test_equal_scores_rank_by_date(spark):
    scores = anomalies.daily_score(_signals(spark, [(D[5], "a", 1.0), (D[2], "a", 1.0)]))
    assert [(r["date"], r["rank"]) for r in anomalies.key_events(scores).collect()] == [(D[2], 1), (D[5], 2)]


def test_rank_uses_unrounded_scores(spark):
    scores = anomalies.daily_score(_signals(spark, [(D[0], "a", 1.001), (D[1], "a", 1.002)]))
    got = [(r["date"], r["total_score"]) for r in anomalies.key_events(scores).collect()]
    assert got == [(D[1], 3.0), (D[0], 3.0)]


def test_ten_per_year(spark):
    scores = anomalies.daily_score(_signals(spark, [(d, "a", float(i)) for i, d in enumerate(D)]))
    out = anomalies.key_events(scores).collect()
    assert [r["rank"] for r in out] == [*range(1, 11)] * 2
    assert [r["year"] for r in out] == [2021] * 10 + [2022] * 10
    for year in (2021, 2022):
        totals = [r["total_score"] for r in out if r["year"] == year]
        assert totals == sorted(totals, reverse=True)


def test_key_event_invariants_on_generated_data(spark, small):
    from daybook.plans.catalogue import QUERIES

    out = QUERIES["key_events"](spark, small).toPandas()
    assert len(out) > 0
    assert ((out["total_score"] - out["severity_score"] - 2 * out["anomaly_count"]).abs() < 0.011).all()
    assert out["date"].is_unique
    for _, year in out.groupby("year"):
        assert list(year["rank"]) == list(range(1, len(year) + 1))
        assert year["total_score"].is_monotonic_decreasing
    for types in out["anomaly_types"]:
        assert types.split(" + ") == sorted(types.split(" + "))
