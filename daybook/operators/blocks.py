"""Cutting ordered series into blocks so that no series has to fit in one task.

``Window.partitionBy(key).orderBy(date)`` sends a whole series to one task, and
one series may hold a large share of all rows. Here the window partition is
(key, block) instead, where a block is a fixed stretch of the order column, and
what a block needs from earlier blocks reaches it in one of two ways:

* *Lead-in rows* (lag, rolling windows): a copy of the last ``n`` rows before
  the block, flagged, so that ordinary window functions see them. Finding them
  moves at most ``n`` rows per block and map task, because the top-n limit is
  applied before the shuffle; a block then gets exactly ``n`` copies, joined by
  their place in the series, wherever the rows before it lie.
* *Carried totals* (running product, running peak): one summary row per block,
  a running total over those few rows, and an equi join back. The large side is
  already partitioned on (key, block), so the join does not move it again.

Rows that repeat an order position are kept, ordered by value, everywhere alike.
What bounds a block is its stretch of time: days for dates, seconds for times, as
short as the rows of the busiest series ask for. The number of summary rows per
series is bounded by the time it covers, not by its rows. Where rows are dense in
places or positions repeat very often, ``block_rows`` bounds blocks by rows instead:
their bounds are then sampled from the rows themselves (see ``cuts``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.cuts import Cuts, sampled_cuts

BLOCK = "_block"
LEAD_IN = "_lead_in"

# Ten years of daily rows, or a month of finer ones. Shorter blocks cost more
# lead-in rows, longer ones more memory per task; some thousand rows per block
# keep a window's row buffer in its in-memory form.
DATE_SPAN_DAYS = 3652
TIMESTAMP_SPAN_DAYS = 30
DAY_SECONDS = 86_400


@dataclass(frozen=True)
class Series:
    """Which columns make up the series, and how long one block is.

    ``span_seconds`` goes before ``span_days``; it suits times, whose rows may be many
    a second. ``block_rows`` goes before both: blocks of about so many rows, whose
    bounds may lie inside a repeated position, at the price of two small jobs when the
    plan is made. Rows that agree in position, value and ``ties`` stay in one block.
    Results do not depend on any of them.
    """

    keys: tuple[str, ...] = ("asset",)
    order: str = "date"
    value: str = "close"
    span_days: int | None = None
    span_seconds: int | None = None
    block_rows: int | None = None
    ties: tuple[str, ...] = ()

    @property
    def places(self) -> list[str]:
        """The columns that order a series, down to rows that repeat a position."""
        return list(dict.fromkeys([self.order, self.value, *self.ties]))

    @property
    def block_keys(self) -> list[str]:
        return [*self.keys, BLOCK]

    def in_block(self) -> WindowSpec:
        # The value only decides where an order position is repeated: both
        # branches of a plan, and tasks that are run again, must agree on it.
        return Window.partitionBy(*self.block_keys).orderBy(*self.places)

    def so_far(self) -> WindowSpec:
        return self.in_block().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def over_blocks(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(BLOCK)

    def earlier_blocks(self) -> WindowSpec:
        return self.over_blocks().rowsBetween(Window.unboundedPreceding, -1)


def with_block(df: DataFrame, series: Series) -> DataFrame:
    """Add the block number, a step function of the order column.

    Rows without a key or a position belong to no series and are left out. Said
    here once for all, that filter reaches the scan and keeps later joins on the
    keys from adding it to one of two otherwise equal branches, which would
    then not share their shuffle. The block is never NULL for the same reason.
    """
    return _blocked(df, series)[0]


def _blocked(df: DataFrame, series: Series) -> tuple[DataFrame, Cuts | None]:
    """The rows with their block, and the bounds of the blocks if these are sampled."""
    placed = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*series.keys, series.order)])
    if series.block_rows:
        rows = df.where(placed)
        cuts = sampled_cuts(rows, series.keys, series.places, series.block_rows)
        return cuts.place(rows, BLOCK), cuts
    return df.where(placed).withColumn(BLOCK, F.coalesce(block_number(df, series), F.lit(0).cast("long"))), None


def block_number(df: DataFrame, series: Series) -> Column:
    """The stretch of time in which the order column of a row lies."""
    is_date = isinstance(df.schema[series.order].dataType, T.DateType)
    days = series.span_days or (DATE_SPAN_DAYS if is_date else TIMESTAMP_SPAN_DAYS)
    span = series.span_seconds or days * DAY_SECONDS
    return F.floor(_seconds(df, series.order) / F.lit(span)).cast("long")


def _seconds(df: DataFrame, order: str) -> Column:
    """Seconds of the order column, the same in any session time zone."""
    at, kind = F.col(order), df.schema[order].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_seconds(at)
    day = F.unix_date(at.cast("date")).cast("long") * DAY_SECONDS
    if isinstance(kind, T.TimestampNTZType):
        return day + F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return day


def lead_in_rows(df: DataFrame, series: Series, columns: Sequence[str], n: int) -> DataFrame:
    """Of rows in blocks, copies of the ``n`` rows before each block, in that block."""
    over_blocks = series.over_blocks()
    if n == 1:
        # of repeated positions the last is that of the greatest value, as in the window
        last_row = F.struct(*series.places)
        last = df.groupBy(*series.block_keys).agg(
            *[F.max_by(c, last_row).alias(c) for c in columns], F.max(series.order).alias(series.order)
        )
        moved = {c: F.lag(c).over(over_blocks) for c in (*columns, series.order)}
        return last.withColumns(moved).where(F.col(series.order).isNotNull())

    newest_first = Window.partitionBy(*series.block_keys).orderBy(*[F.desc(c) for c in series.places])
    tails = (
        df.select(*series.block_keys, series.order, *columns)
        .withColumn("_from_end", F.row_number().over(newest_first))
        .where(F.col("_from_end") <= n)
        .withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy(*series.block_keys)))
    )
    # Places are counted over the tails alone: what a longer block has before its last
    # n rows is never among the n rows before a later block.
    ends = tails.where(F.col("_from_end") == 1).select(
        *series.block_keys, F.sum("_size").over(over_blocks.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"), "_size"
    )
    placed = tails.drop("_size").join(ends.drop("_size"), series.block_keys).withColumn("_place", F.col("_end") - F.col("_from_end"))
    start = F.col("_end") - F.col("_size")
    wanted = ends.select(
        *series.keys, F.col(BLOCK).alias("_to"), start.alias("_start"),
        F.explode(F.sequence(F.floor((start - n) / n), F.floor((start - 1) / n))).alias("_cell"),
    ).where(F.col("_start") > 0)
    copies = placed.withColumn("_cell", F.floor(F.col("_place") / n)).join(wanted, [*series.keys, "_cell"])
    near = (F.col("_place") < F.col("_start")) & (F.col("_place") >= F.col("_start") - n)
    return copies.where(near).select(*series.keys, F.col("_to").alias(BLOCK), series.order, *columns)


def with_lead_in(df: DataFrame, series: Series, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows in blocks, each block led by copies of the ``n`` rows before it.

    The copies carry keys, order, value and the given ``columns``; other columns
    are NULL there. Drop the copies with ``own_rows``.
    """
    columns = list(dict.fromkeys([*series.places[1:], *(columns or [])]))
    blocked, cuts = _blocked(df, series)
    copies = lead_in_rows(blocked, series, columns, n)
    rows = blocked.withColumn(LEAD_IN, F.lit(False)).unionByName(
        copies.withColumn(LEAD_IN, F.lit(True)), allowMissingColumns=True
    )
    return cuts.dealt(rows, series.block_keys) if cuts else rows


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col(LEAD_IN))


def without_marks(df: DataFrame) -> DataFrame:
    return df.drop(BLOCK, LEAD_IN)


def carried(column: Column, series: Series) -> Column:
    """An aggregate over the blocks before the current one."""
    return column.over(series.earlier_blocks())
