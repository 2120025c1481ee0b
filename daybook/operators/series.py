"""Per-series features: returns, growth, rolling risk, momentum and drawdown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.functions.series import (
    below_peak,
    change_over_rows,
    merged_moments,
    moments,
    relative_change,
    sample_deviation,
)
from daybook.operators.blocks import (
    LEAD_IN,
    Series,
    carried,
    own_rows,
    with_lead_in,
    without_marks,
)

PRICE_SERIES = Series()
VOLATILITY_ROWS = 30
MOMENTUM_ROWS = (30, 90)


def with_return(rows: DataFrame, series: Series) -> DataFrame:
    return rows.withColumn("daily_return", change_over_rows(F.col(series.value), 1, series.in_block()))


def _with_momentum(rows: DataFrame, series: Series, spans: Sequence[int]) -> DataFrame:
    ordered = series.in_block()
    return rows.withColumns(
        {f"rolling_return_{n}d": change_over_rows(F.col(series.value), n, ordered) for n in spans}
    )


def _with_volatility(rows: DataFrame, series: Series, n: int) -> DataFrame:
    """Add the sample deviation of the last ``n`` returns, NULL unless all are present.

    A block is laid out in stretches of ``n`` rows. A window of ``n`` rows is the end of
    one stretch and the start of the next, so the moments from each row to the end of its
    stretch and those from the stretch's start to each row are merged: the work per row
    does not depend on ``n``, and nothing is subtracted that would have to cancel.
    """
    ordered, value = series.in_block(), F.col("daily_return")
    rows = rows.withColumn("_nth", F.row_number().over(ordered) - 1).withColumn("_stretch", F.floor(F.col("_nth") / n))
    stretch = Window.partitionBy(*series.block_keys, "_stretch")
    upward = stretch.orderBy("_nth").rowsBetween(Window.unboundedPreceding, 0)
    downward = stretch.orderBy(F.desc("_nth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_rest", moments(value, downward)).withColumn("_so_far", moments(value, upward))
    by_place = Window.partitionBy(*series.block_keys).orderBy("_nth")
    before = F.when(F.col("_nth") % n != n - 1, F.lag("_rest", n - 1).over(by_place))
    rows = rows.withColumn("_before", before)
    deviation = sample_deviation(merged_moments(F.col("_before"), F.col("_so_far")), n)
    return rows.withColumn(f"volatility_{n}d", deviation).drop("_nth", "_stretch", "_rest", "_so_far", "_before")


def _with_growth(rows: DataFrame, series: Series) -> DataFrame:
    """Add ``cum_return``, its peak so far, and the peak of the value itself.

    ``rows`` still has its lead-in rows and ``daily_return``; they are dropped
    here. A row without a return has growth 1, and the product goes on after it.
    Growth relative to the start of the block is scaled by what was carried into
    the block; both its highest and its lowest point are kept, since a negative
    carry turns the lowest into the peak.
    """
    rows = growth_in_block(rows, series)
    return carried_growth(rows, carries_of(rows, series), series)


def growth_in_block(rows: DataFrame, series: Series) -> DataFrame:
    present = F.col("daily_return").isNotNull()
    factor = F.when(present & ~F.col(LEAD_IN), F.col("daily_return") + 1)
    rows = own_rows(rows.withColumn("_growth", F.product(factor).over(series.so_far())))
    return rows.withColumn("_growth", F.when(present, F.col("_growth")))


def _peak(carry, high, low, restarted) -> Column:
    return F.greatest(carry * high, carry * low, F.when(restarted, F.lit(1.0)))


def carries_of(rows: DataFrame, series: Series) -> DataFrame:
    """(keys, block, carries): what each block needs of those before it, a row each."""
    present = F.col("daily_return").isNotNull()
    blocks = rows.groupBy(*series.block_keys).agg(
        F.product(F.col("daily_return") + 1).alias("_product"),
        F.max("_growth").alias("_block_high"),
        F.min("_growth").alias("_block_low"),
        F.bool_or(~present).alias("_block_restarted"),
        F.max(series.value).alias("_block_top"),
    )
    entering = F.coalesce(carried(F.product(F.coalesce("_product", F.lit(1.0))), series), F.lit(1.0))
    return (
        blocks.withColumn("_carry", entering)
        .withColumn(
            "_block_peak",
            _peak(F.col("_carry"), F.col("_block_high"), F.col("_block_low"), F.col("_block_restarted")),
        )
        .select(
            *series.block_keys,
            "_carry",
            carried(F.max("_block_peak"), series).alias("_carry_peak"),
            carried(F.max("_block_top"), series).alias("_carry_top"),
        )
    )


def carried_growth(rows: DataFrame, carries: DataFrame, series: Series) -> DataFrame:
    so_far, present = series.so_far(), F.col("daily_return").isNotNull()
    reached = rows.withColumns(
        {
            "_high": F.max("_growth").over(so_far),
            "_low": F.min("_growth").over(so_far),
            "_restarted": F.bool_or(~present).over(so_far),
            "_top": F.max(series.value).over(so_far),
        }
    )
    joined = reached.join(carries, series.block_keys, "left")
    here = _peak(F.col("_carry"), F.col("_high"), F.col("_low"), F.col("_restarted"))
    return joined.withColumns(
        {
            "cum_return": F.when(present, F.col("_carry") * F.col("_growth")).otherwise(F.lit(1.0)),
            "growth_peak": F.greatest("_carry_peak", here),
            "rolling_max": F.when(F.col(series.value).isNotNull(), F.greatest("_carry_top", "_top")),
        }
    ).drop(
        "_growth", "_high", "_low", "_restarted", "_top", "_carry", "_carry_peak", "_carry_top"
    )


def daily_return(prices: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """Relative change against the previous row; NULL on the first."""
    return without_marks(own_rows(with_return(with_lead_in(prices, series, 1), series)))


def rolling_return(
    prices: DataFrame, spans: Sequence[int] = MOMENTUM_ROWS, series: Series = PRICE_SERIES
) -> DataFrame:
    """Relative change over n rows, not n days, for each n in ``spans``."""
    return without_marks(own_rows(_with_momentum(with_lead_in(prices, series, max(spans)), series, spans)))


def rolling_volatility(
    prices: DataFrame, n: int = VOLATILITY_ROWS, series: Series = PRICE_SERIES
) -> DataFrame:
    """Sample deviation of the last ``n`` daily returns."""
    rows = with_return(with_lead_in(prices, series, n), series)
    return without_marks(own_rows(_with_volatility(rows, series, n)))


def cumulative_return(prices: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """Running product of ``1 + daily_return``, 1 where the return is missing."""
    rows = with_return(with_lead_in(prices, series, 1), series)
    return without_marks(_with_growth(rows, series)).drop("growth_peak", "rolling_max")


def drawdown_series(prices: DataFrame, basis: str = "close", series: Series = PRICE_SERIES) -> DataFrame:
    """Running peak and the distance from it, on the value or on ``cum_return``."""
    rows = _with_growth(with_return(with_lead_in(prices, series, 1), series), series)
    if basis == "cum_return":
        rows = rows.withColumn("rolling_max", F.col("growth_peak"))
        drawdown = below_peak(F.col("cum_return"), F.col("rolling_max"))
    else:
        drawdown = relative_change(F.col(series.value), F.col("rolling_max"))
    return without_marks(rows.withColumn("drawdown", drawdown)).drop("growth_peak")


def price_features(
    prices: DataFrame,
    series: Series = PRICE_SERIES,
    volatility_rows: int = VOLATILITY_ROWS,
    momentum_rows: Sequence[int] = MOMENTUM_ROWS,
) -> DataFrame:
    """All features of a price series; the prices themselves are shuffled once."""
    return _features(prices, series, volatility_rows, momentum_rows).drop("growth_peak")


def _features(
    prices: DataFrame, series: Series, volatility_rows: int, momentum_rows: Sequence[int]
) -> DataFrame:
    rows = row_features(with_lead_in(prices, series, max(volatility_rows, *momentum_rows, 1)), series, volatility_rows, momentum_rows)
    return without_marks(with_drawdown(_with_growth(rows, series), series))


def row_features(rows: DataFrame, series: Series, volatility_rows: int, momentum_rows: Sequence[int]) -> DataFrame:
    rows = _with_momentum(with_return(rows, series), series, momentum_rows)
    return _with_volatility(rows, series, volatility_rows)


def with_drawdown(rows: DataFrame, series: Series) -> DataFrame:
    return rows.withColumn("drawdown", relative_change(F.col(series.value), F.col("rolling_max")))


def with_returns_and_risk(prices: DataFrame, series: Series, volatility_rows: int) -> DataFrame:
    """Rows in blocks with their return and its rolling deviation."""
    rows = with_return(with_lead_in(prices, series, volatility_rows), series)
    return own_rows(_with_volatility(rows, series, volatility_rows))


def growth_and_risk(
    prices: DataFrame, series: Series = PRICE_SERIES, volatility_rows: int = VOLATILITY_ROWS
) -> DataFrame:
    """Input of the per-series metrics: volatility and drawdown of the growth."""
    rows = with_return(with_lead_in(prices, series, volatility_rows), series)
    rows = _with_growth(_with_volatility(rows, series, volatility_rows), series)
    return without_marks(
        rows.withColumn("growth_drawdown", below_peak(F.col("cum_return"), F.col("growth_peak")))
    ).drop("growth_peak", "rolling_max")
