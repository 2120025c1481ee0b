"""Series kept with what their blocks need, so that a date range is read on its own.

Features of a day depend on all history before it. Beside the rows, in a folder per
block, the lead-in rows of each block and its carries (growth, peaks) are kept. A request
for a range of dates reads the blocks it touches, their lead-in rows and their carries;
what came before is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import series as features
from daybook.operators.blocks import BLOCK, LEAD_IN, Series, block_number, lead_in_rows, with_block, without_marks
from daybook.operators.series import MOMENTUM_ROWS, PRICE_SERIES, VOLATILITY_ROWS

_ROWS, _LEAD, _CARRIES = "rows", "lead_in", "carries"


def store_series(
    prices: DataFrame,
    path: str,
    series: Series = PRICE_SERIES,
    volatility_rows: int = VOLATILITY_ROWS,
    momentum_rows: Sequence[int] = MOMENTUM_ROWS,
) -> None:
    """Keep ``prices`` below ``path`` for ``stored_features`` with the same settings.

    Blocks are stretches of time, one folder each, and rows are brought together per
    block before they are written.
    """
    if series.block_rows:
        raise ValueError("blocks of a stored series are stretches of time")
    spark, lead = prices.sparkSession, max(volatility_rows, *momentum_rows, 1)
    with_block(prices, series).hint("rebalance", BLOCK).write.partitionBy(BLOCK).parquet(f"{path}/{_ROWS}")
    rows = _blocks(spark, path, _ROWS, prices, series)
    lead_in_rows(rows, series, [*series.places[1:]], lead).hint("rebalance", BLOCK).write.partitionBy(BLOCK).parquet(f"{path}/{_LEAD}")
    in_block = features.growth_in_block(features.with_return(_with_lead(rows, _blocks(spark, path, _LEAD, prices, series)), series), series)
    features.carries_of(in_block, series).write.parquet(f"{path}/{_CARRIES}")


def _blocks(spark: SparkSession, path: str, part: str, prices: DataFrame, series: Series) -> DataFrame:
    columns = prices.columns if part == _ROWS else [*series.keys, *series.places]
    schema = prices.select(*dict.fromkeys(columns)).schema.add(BLOCK, "long")
    return spark.read.schema(schema).parquet(f"{path}/{part}")


def _with_lead(rows: DataFrame, lead: DataFrame) -> DataFrame:
    return rows.withColumn(LEAD_IN, F.lit(False)).unionByName(lead.withColumn(LEAD_IN, F.lit(True)), allowMissingColumns=True)


def stored_features(
    spark: SparkSession,
    path: str,
    prices: DataFrame,
    start: str,
    end: str,
    series: Series = PRICE_SERIES,
    volatility_rows: int = VOLATILITY_ROWS,
    momentum_rows: Sequence[int] = MOMENTUM_ROWS,
) -> DataFrame:
    """``price_features`` of the rows from ``start`` up to ``end``, end excluded.

    ``prices`` only gives the columns and types. Equal to computing the features of all
    history and clipping after; the scans are bounded by the blocks of the range.
    """
    kind = prices.schema[series.order].dataType
    begin, stop = (F.lit(v).cast(kind) for v in (start, end))
    ends = spark.range(1).select(F.explode(F.array(begin, stop)).alias(series.order))
    first, last = sorted(r[0] for r in ends.select(block_number(ends, series)).collect())
    wanted = F.col(BLOCK).between(first, last)
    rows = _with_lead(*(_blocks(spark, path, part, prices, series).where(wanted) for part in (_ROWS, _LEAD)))
    carries = spark.read.parquet(f"{path}/{_CARRIES}").where(wanted)
    given = features.row_features(rows, series, volatility_rows, momentum_rows)
    grown = features.carried_growth(features.growth_in_block(given, series), carries, series)
    out = without_marks(features.with_drawdown(grown, series)).drop("growth_peak")
    return out.where((F.col(series.order) >= begin) & (F.col(series.order) < stop))
