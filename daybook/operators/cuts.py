"""Ranges of about equal rows over a total order, so that no stretch of it is hot.

Fixed stretches of time hold as many rows as the data put there. Here the bounds come
from a sample of the rows themselves, over (keys, order columns): a key, or a single
position, that holds a large share of all rows is cut as often as its rows ask for.

The bounds are sampled once and kept as a small table in the shared folder, so every
branch of a plan and every task that is run again sees the same ones. Results never
depend on where the bounds lie, only the balance does.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import shared_path

#: Most bounds of one table, which bounds what is broadcast; ranges grow beyond that.
MAX_CUTS = 16_384
#: Rows sampled for each range: of so many the largest range is rarely twice the mean.
SAMPLED = 48
#: Rows of a task that is dealt whole ranges, in the mean.
TASK_ROWS = 200_000
_CUTS, _HERE = "_cuts", "_here"


@dataclass(frozen=True)
class Cuts:
    """Bounds of a table of ``rows`` rows; ``table`` is None where it is too small for any."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    table: DataFrame | None
    rows: int = 0

    def dealt(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows dealt out by the keys, which name a range, to tasks of some ``TASK_ROWS`` rows.

        Left alone, adaptive execution merges shuffle partitions by their compressed
        bytes: rows that compress well would come together in a few tasks, and what
        these sort in memory grows with the table.
        """
        if self.table is None:
            return df
        least = df.sparkSession.sparkContext.defaultParallelism
        return df.repartition(max(least, -(-self.rows // TASK_ROWS)), *keys)

    def place(self, df: DataFrame, name: str) -> DataFrame:
        """Add the number of bounds of the row's key that are not after the row.

        Along the order the number never falls, rows that are equal in it share one,
        and NULL is before all values.
        """
        if self.table is None:
            return df.withColumn(name, F.lit(0).cast("long"))
        here = F.struct(*[F.col(c) for c in self.order])
        on = [*self.keys, _HERE]
        joined = df.withColumn(_HERE, _one(self.order)).join(F.broadcast(self.table), on, "left")
        return joined.withColumn(name, F.coalesce(_bounds_up_to(here), F.lit(0)).cast("long")).drop(_CUTS, _HERE)


def _one(order: Sequence[str]) -> Column:
    """A column that is the same in all rows but no constant, for a join without keys."""
    return F.hash(order[0]).bitwiseAND(0)


def _bounds_up_to(here: Column) -> Column:
    """How many elements of the sorted bounds are at most ``here``, by halving steps."""
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(MAX_CUTS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(_CUTS, at + step - 1) <= here, at + step).otherwise(at))


def sampled_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, seed: int = 7) -> Cuts:
    """Bounds so that a range holds about ``rows`` rows of ``df``.

    Two small jobs run at once: a count, and a sample of ``SAMPLED`` rows for each range,
    sorted in one task (some 800,000 rows at most). Tables of up to ``rows`` rows get no
    bounds.
    """
    columns = list(dict.fromkeys([*keys, *order]))
    slim = df.select(*columns)
    total = slim.count()
    ranges = min(MAX_CUTS, -(-total // rows))
    if ranges <= 1:
        return Cuts(tuple(keys), tuple(order), None, total)
    # a smaller share than one row in a billion is not asked for: ranges are bounded
    sample = slim.sample(min(1.0, SAMPLED * ranges / total), seed)
    in_order = Window.orderBy(*[F.asc_nulls_first(c) for c in columns])
    every = max(1, min(SAMPLED, total // ranges))
    bounds = (
        sample.withColumn("_nth", F.row_number().over(in_order))
        .where(F.col("_nth") % every == 0)
        .drop("_nth")
        .withColumn(_HERE, _one(order))
        .groupBy(*keys, _HERE)
        .agg(F.array_sort(F.collect_set(F.struct(*order))).alias(_CUTS))
    )
    path = shared_path(df.sparkSession, "cuts")
    bounds.write.parquet(path)
    return Cuts(tuple(keys), tuple(order), df.sparkSession.read.schema(bounds.schema).parquet(path), total)


def before_blocks(df: DataFrame, keys: Sequence[str], block: str, **totals: tuple[Column, str]) -> DataFrame:
    """(keys, block, name..): of each block, what the blocks before it come to.

    A total is (aggregate over the rows of a block, name of the aggregate that merges
    totals of blocks); it is NULL for the first block of a key.
    """
    each = df.groupBy(*keys, block).agg(*[total.alias(name) for name, (total, _) in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    merged = [getattr(F, merge)(name).over(earlier).alias(name) for name, (_, merge) in totals.items()]
    return each.select(*keys, block, *merged)
