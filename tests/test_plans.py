"""Physical plans: what is shuffled, shared, limited and pushed down."""

from __future__ import annotations

import re

from daybook.operators import anomalies, news, ranges, series
from daybook.plans import relations as rel
from daybook.plans.catalogue import QUERIES
from daybook.sinks import overwrite_files


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _executed(df) -> str:
    df.collect()
    return _plan(df).split("== Initial Plan ==")[0]


def test_features_shuffle_the_prices_once(spark, small, tmp_path):
    path = str(tmp_path / "prices")
    rel.prices(spark, small).write.parquet(path)
    final = _executed(series.price_features(spark.read.parquet(path)))
    big = [line for line in final.splitlines() if re.search(r"(?<!Reused)Exchange hashpartitioning\(asset#\d+, _block", line)]
    reused = [line for line in final.splitlines() if "ReusedExchange [" in line and "_lead_in" in line]
    # One for the rows, shared by both branches, and one for the limited tails.
    assert len([line for line in big if "+- ReusedExchange" not in line]) == 2
    assert len(reused) == 1
    assert "WindowGroupLimit" in final
    assert "SinglePartition" not in final


def test_join_back_does_not_move_the_rows_even_without_broadcast(spark, small):
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in thresholds:
        spark.conf.set(name, "-1")
    try:
        lines = _plan(series.cumulative_return(rel.prices(spark, small))).splitlines()
    finally:
        for name in thresholds:
            spark.conf.unset(name)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lines[join + 1].index(":-")
    left = []
    for line in lines[join + 1 :]:
        if line[depth : depth + 2] == "+-":
            break
        left.append(line)
    windows = [i for i, line in enumerate(left) if "Window [" in line]
    exchanges = [i for i, line in enumerate(left) if "Exchange" in line]
    # The nearest shuffle on the row side is the one below the windows.
    assert min(exchanges) > min(windows)
    assert "_block" in left[min(exchanges)]


def test_whole_history_windows_never_partition_by_asset_alone(spark, small):
    """Rows are windowed per block; only block summaries are windowed per asset."""
    plan = _plan(series.price_features(rel.prices(spark, small)))
    for line in plan.splitlines():
        if "Window [" in line and re.search(r"\], \[asset#\d+\], \[", line):
            assert re.search(r"\[_block#\d+L? ASC", line)


def test_single_series_is_not_sorted_in_one_task(spark, small):
    plan = _plan(anomalies.volatility_anomaly(rel.vix(spark, small)))
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "max_by(vix_close" in lines[i + 1] or "HashAggregate(keys=[_block" in "".join(lines[i + 1 : i + 4])


def test_ranking_is_limited_before_the_shuffle(spark, small):
    plan = _plan(QUERIES["key_events"](spark, small))
    assert re.search(r"WindowGroupLimit \[year#\d+\].*Partial", plan)


def test_items_are_filtered_without_a_shuffle_and_limited_before_one(spark, small, tmp_path):
    events = overwrite_files(rel.key_events_table(spark, small), str(tmp_path / "events"))
    plan = _plan(news.enrich_events(events, rel.items(spark, small), first=3))
    assert re.search(r"WindowGroupLimit \[event_date#\d+\].*Partial", plan)
    # Plans read upwards: the semi join is below the limit, and not a sorted one.
    assert plan.index("WindowGroupLimit") < plan.index("LeftSemi")
    assert not re.search("SortMergeJoin.*LeftSemi", plan)


def test_date_bounds_reach_the_scan(spark, small):
    clipped = rel.prices_between(
        spark, small, lambda o: ranges.history_window(o, "o_orderdate", "1996-01-01", "1999-12-31")
    )
    plan = _plan(clipped)
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_scans_read_only_what_is_used(spark, small):
    schema = re.findall(r"ReadSchema: struct<([^>]*)>", _plan(rel.vix(spark, small)))
    assert schema == ["l_shipdate:timestamp_ntz"]


def test_stats_are_joined_without_a_hint(spark, small):
    plan = anomalies.return_zscore(rel.returns(spark, small))
    assert "hint" not in plan._jdf.queryExecution().logical().toString().lower()
