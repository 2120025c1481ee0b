"""One row per asset: growth, worst fall, average risk."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.series import annual_growth, latest_present
from daybook.operators.blocks import BLOCK, Series, with_block
from daybook.operators.drawdown import growth_pieces, lowest_point
from daybook.operators.series import PRICE_SERIES, VOLATILITY_ROWS, growth_and_risk, with_returns_and_risk


def _annual_growth(series: Series):
    return annual_growth(
        F.min_by(series.value, F.struct(series.order, series.value)),
        F.max_by(series.value, F.struct(series.order, series.value)),
        F.datediff(F.max(series.order), F.min(series.order)),
    )


def cagr(prices: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """Compound annual growth from the first to the last row; no ordering needed.

    Rows without key or position are left out, as in every metric.
    """
    return prices.dropna(subset=[*series.keys, series.order]).groupBy(*series.keys).agg(_annual_growth(series).alias("cagr"))


def max_drawdown(prices: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """Lowest point of the cumulative return below its own peak.

    One aggregate per block that merges along the series (see ``drawdown``); the rows
    are moved once and not windowed. ``portfolio_metrics`` has all metrics at once.
    """
    rows = with_block(prices.select(*series.keys, *series.places), series)
    pieces = rows.groupBy(*series.block_keys).agg(growth_pieces(series).alias("_pieces"))
    lows = lowest_point(pieces, series)
    return lows.groupBy(*series.keys).agg(F.min("_low").alias("max_drawdown"))


def mean_volatility(
    prices: DataFrame, series: Series = PRICE_SERIES, volatility_rows: int = VOLATILITY_ROWS
) -> DataFrame:
    """Mean of the rolling volatility, rows without one left out."""
    return average_volatility(growth_and_risk(prices, series, volatility_rows), series, volatility_rows)


def average_volatility(
    rows: DataFrame, series: Series = PRICE_SERIES, volatility_rows: int = VOLATILITY_ROWS
) -> DataFrame:
    """``mean_volatility`` of rows that ``growth_and_risk`` gave."""
    name = f"volatility_{volatility_rows}d"
    return rows.groupBy(*series.keys).agg(F.avg(name).alias(f"avg_{name}"))


def portfolio_metrics(
    prices: DataFrame, series: Series = PRICE_SERIES, volatility_rows: int = VOLATILITY_ROWS
) -> DataFrame:
    """The three metrics from one aggregate per block, so that no rows are joined."""
    name = f"volatility_{volatility_rows}d"
    end = F.struct(series.order, series.value)
    blocks = with_returns_and_risk(prices, series, volatility_rows).groupBy(*series.block_keys).agg(
        growth_pieces(series).alias("_pieces"),
        F.min(end).alias("_first"),
        F.max(end).alias("_last"),
        F.sum(name).alias("_risk"),
        F.count(name).alias("_risks"),
    )
    first, last = F.min("_first"), F.max("_last")
    days = F.datediff(last[series.order], first[series.order])
    return (
        lowest_point(blocks, series)
        .groupBy(*series.keys)
        .agg(
            annual_growth(first[series.value], last[series.value], days).alias("cagr"),
            F.min("_low").alias("max_drawdown"),
            F.try_divide(F.sum("_risk"), F.sum("_risks")).alias(f"avg_{name}"),
        )
    )


def lowest_drawdown(rows: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """``max_drawdown`` of rows that ``growth_and_risk`` gave."""
    return rows.groupBy(*series.keys).agg(F.min("growth_drawdown").alias("max_drawdown"))


def metrics_join_chain(growth: DataFrame, drawdown: DataFrame, risk: DataFrame, key: str = "asset") -> DataFrame:
    """The same table from three separately kept ones, each with one row per key."""
    return growth.join(drawdown, key).join(risk, key)


def asset_summary(features: DataFrame, series: Series = PRICE_SERIES) -> DataFrame:
    """Last, mean and lowest values of the feature columns per asset.

    "Last" is the last value present, by date.
    """
    order = F.col(series.order)
    return features.groupBy(*series.keys).agg(
        latest_present(F.col("cum_return"), order).alias("final_cum_return"),
        F.avg("volatility_30d").alias("avg_volatility_30d"),
        F.min("drawdown").alias("max_drawdown"),
        latest_present(F.col("rolling_return_30d"), order).alias("latest_30d_return"),
        latest_present(F.col("rolling_return_90d"), order).alias("latest_90d_return"),
    )


def group_metric_apply(
    prices: DataFrame,
    partial: Callable[[pd.DataFrame], dict],
    state: str,
    finish: Callable[[pd.DataFrame], dict],
    result: str,
    series: Series = PRICE_SERIES,
) -> DataFrame:
    """A caller's own metric per key, in Python.

    A function over a whole group would need that group in one task. The metric
    is therefore given in two parts: ``partial`` turns one block of rows (a
    bounded stretch of the series, in order) into one row of ``state``;
    ``finish`` turns the state rows of one key, in order, into the ``result``.
    """
    fields = [prices.schema[k] for k in series.keys]
    keys = T.StructType(fields)
    block = T.StructField(BLOCK, T.LongType())
    state_columns = T.StructType.fromDDL(state).fields
    result_columns = T.StructType.fromDDL(result).fields
    names, order, value = list(series.keys), series.order, series.value

    def one_block(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = partial(rows.sort_values([order, value], kind="stable", na_position="first"))
        return pd.DataFrame([dict(zip([*names, BLOCK], group, strict=True)) | made])

    def one_key(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = finish(rows.sort_values(BLOCK))
        return pd.DataFrame([dict(zip(names, group, strict=True)) | made])

    blocked = with_block(prices.select(*series.keys, series.order, series.value), series)
    states = blocked.groupBy(*series.block_keys).applyInPandas(
        one_block, T.StructType([*fields, block, *state_columns])
    )
    return states.groupBy(*series.keys).applyInPandas(one_key, T.StructType([*keys.fields, *result_columns]))
