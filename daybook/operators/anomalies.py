"""Anomalous days: detection per signal, union, daily score, ranking."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.series import relative_change
from daybook.operators.blocks import Series, own_rows, with_lead_in, without_marks
from daybook.operators.concat import repeated_in_order
from daybook.schemas import PRICE_SIGNAL, SENTIMENT_SIGNAL, SIGNAL_SEPARATOR, VOLATILITY_SIGNAL

# One series each, without a key column; a table of several such indexes takes
# ``Series(keys=("series_id",), ...)``.
SENTIMENT_SERIES = Series(keys=(), order="date", value="fng_value")
VOLATILITY_SERIES = Series(keys=(), order="date", value="vix_close")

SIGMAS = 2.0
SENTIMENT_MINIMUM, SENTIMENT_SCALE = 10.0, 10.0
VOLATILITY_MINIMUM, VOLATILITY_SCALE = 20.0, 20.0
COUNT_WEIGHT = 2
EVENTS_PER_YEAR = 10


def return_stats(returns: DataFrame, key: str = "asset") -> DataFrame:
    """Mean and sample deviation of the returns of each asset, over its whole history."""
    return (
        returns.where(F.col("daily_return").isNotNull())
        .groupBy(key)
        .agg(
            F.avg("daily_return").alias("mean_return"),
            F.stddev_samp("daily_return").alias("std_return"),
        )
    )


def return_zscore(returns: DataFrame, key: str = "asset") -> DataFrame:
    """Each return as deviations from the mean of its own asset.

    An aggregate joined back rather than a window over the asset: the aggregate
    combines before the shuffle, and the join may be broadcast or split where an
    asset is large. Spark decides from the measured size, so there is no hint.
    """
    present = returns.where(F.col("daily_return").isNotNull())
    return present.join(return_stats(returns, key), key).withColumn(
        "zscore", F.try_divide(F.col("daily_return") - F.col("mean_return"), F.col("std_return"))
    )


def price_anomaly(
    returns: DataFrame, sigmas: float = SIGMAS, label: str = PRICE_SIGNAL, key: str = "asset"
) -> DataFrame:
    """Days on which any asset moved more than ``sigmas`` deviations; worst asset counts."""
    away = F.abs(F.col("daily_return") - F.col("mean_return"))
    return (
        return_zscore(returns, key)
        .where(away > F.lit(sigmas) * F.col("std_return"))
        .groupBy(F.to_date("date").alias("date"))
        .agg(F.max(F.abs("zscore")).alias("severity"))
        .select("date", F.lit(label).alias("anomaly_type"), "severity")
    )


def row_change(df: DataFrame, series: Series, kind: str = "abs", alias: str = "daily_change") -> DataFrame:
    """Change against the previous row: absolute, or in percent with its sign."""
    rows = with_lead_in(df, series, 1)
    before, now = F.lag(series.value).over(series.in_block()), F.col(series.value)
    if kind == "abs":
        change = F.abs(now - before)
    elif kind == "pct":
        change = relative_change(now, before) * F.lit(100.0)
    else:
        raise ValueError(f"unknown kind of change: {kind}")
    return without_marks(own_rows(rows.withColumn(alias, change)))


def change_anomaly(
    df: DataFrame, series: Series, kind: str, minimum: float, scale: float, label: str
) -> DataFrame:
    """Days whose change is strictly above ``minimum``; severity is change / scale.

    Not grouped by day: two rows on one day may both be anomalous.
    """
    return (
        row_change(df, series, kind)
        .where(F.col("daily_change") > F.lit(minimum))
        .select(
            F.to_date(series.order).alias("date"),
            F.lit(label).alias("anomaly_type"),
            (F.col("daily_change") / F.lit(scale)).alias("severity"),
        )
    )


def sentiment_anomaly(fear_greed: DataFrame, series: Series = SENTIMENT_SERIES) -> DataFrame:
    """Sentiment moved by more than 10 points, either way."""
    return change_anomaly(fear_greed, series, "abs", SENTIMENT_MINIMUM, SENTIMENT_SCALE, SENTIMENT_SIGNAL)


def volatility_anomaly(vix: DataFrame, series: Series = VOLATILITY_SERIES) -> DataFrame:
    """Volatility rose by more than 20 percent; falls do not count."""
    return change_anomaly(vix, series, "pct", VOLATILITY_MINIMUM, VOLATILITY_SCALE, VOLATILITY_SIGNAL)


def combine_anomalies(signals: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, signals)


def daily_score(
    anomalies: DataFrame, weight: int = COUNT_WEIGHT, separator: str = SIGNAL_SEPARATOR
) -> DataFrame:
    """One row per day: how many signals, their total severity, and a score of both.

    Reduced per day and signal first, which bounds what a day can bring to the
    second step by the number of signals, however often a signal repeats.
    """
    per_signal = anomalies.groupBy("date", "anomaly_type").agg(
        F.count(F.lit(1)).alias("_copies"), F.sum("severity").alias("_severity")
    )
    signals, severity = F.count("anomaly_type"), F.sum("_severity")
    return per_signal.groupBy("date").agg(
        F.year("date").alias("year"),
        signals.alias("anomaly_count"),
        severity.alias("severity_score"),
        (signals * F.lit(weight) + severity).alias("total_score"),
        repeated_in_order("anomaly_type", "_copies", separator).alias("anomaly_types"),
    )


def top_per_year(scores: DataFrame, n: int = EVENTS_PER_YEAR) -> DataFrame:
    """The ``n`` highest scores of each year, ties by date.

    The rank limit is applied before the shuffle too, so a year costs at most
    ``n`` rows per map task.
    """
    best_first = Window.partitionBy("year").orderBy(F.desc("total_score"), "date")
    return scores.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= n)


def key_events(scores: DataFrame, n: int = EVENTS_PER_YEAR) -> DataFrame:
    """Ranked on full precision, rounded last, in the order of the report."""
    return (
        top_per_year(scores, n)
        .select(
            "date",
            "year",
            "rank",
            "anomaly_count",
            "anomaly_types",
            F.round("severity_score", 2).alias("severity_score"),
            F.round("total_score", 2).alias("total_score"),
        )
        .orderBy("year", "rank")
    )


def key_events_from(prices_with_return: DataFrame, fear_greed: DataFrame, vix: DataFrame) -> DataFrame:
    """The three signals to the ranked table."""
    return key_events(
        daily_score(
            combine_anomalies(
                [price_anomaly(prices_with_return), sentiment_anomaly(fear_greed), volatility_anomaly(vix)]
            )
        )
    )
