"""The worst drawdown of a growth path from one small state per block.

The path is the running product of the factors from value to value. Of a stretch of rows
these numbers, relative to its first row, are enough and merge along the series: the
product, the peak, the trough, the worst fall inside, and the peak at the last row
without a factor (there the path is 1, but the product goes on). With a growth ``c`` and
a peak ``p`` reached before, the lowest point of the stretch is the lower of the trough
``c * trough / p - 1`` and the fall inside, since a share of the greater of two peaks is
the lesser of both shares.

That holds as long as growth does not change its sign. A block is therefore cut into
pieces at negative factors; in a piece after an odd number of them growth is negative
and only its peak against ``p`` counts. ``p`` is at least 1, where every series starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.blocks import BLOCK, Series

_PIECE = ("turn", "product", "peak", "trough", "fall", "gap")


def growth_pieces(series: Series) -> Column:
    """Aggregate over a block: (first, last, pieces), see ``lowest_point``.

    The block's values are sorted and folded once; nothing is windowed.
    """
    one, none = F.lit(1.0), F.lit(None).cast("double")

    def piece(state: Column) -> Column:
        return F.struct(*[state[name].alias(name) for name in _PIECE])

    no_pieces = F.array().cast("array<struct<" + ",".join(f"{name}:double" for name in _PIECE) + ">>")
    start = F.struct(
        F.lit(False).alias("begun"), none.alias("first"), none.alias("last"), no_pieces.alias("done"),
        *[one.alias(name) for name in _PIECE[:-1]], none.alias("gap"),
    )

    def step(state: Column, row: Column) -> Column:
        value = row[series.value].cast("double")
        factor = F.try_divide(value, state["last"])
        begun, turned, missing = state["begun"], factor < 0, factor.isNull()
        product = state["product"] * factor
        peak = F.greatest(state["peak"], product)

        def field(name: str, ahead: Column, at_turn: Column, at_gap: Column) -> Column:
            here = F.when(~begun, state[name]).when(missing, at_gap).when(turned, at_turn).otherwise(ahead)
            return here.alias(name)

        same = {name: state[name] for name in _PIECE}
        return F.struct(
            F.lit(True).alias("begun"),
            F.when(begun, state["first"]).otherwise(value).alias("first"),
            value.alias("last"),
            F.when(begun & turned, F.array_append(state["done"], piece(state))).otherwise(state["done"]).alias("done"),
            field("turn", same["turn"], factor, same["turn"]),
            field("product", product, one, same["product"]),
            field("peak", peak, one, same["peak"]),
            field("trough", F.least(state["trough"], product), one, same["trough"]),
            field("fall", F.least(state["fall"], product / peak), one, same["fall"]),
            field("gap", same["gap"], none, same["peak"]),
        )

    def finish(state: Column) -> Column:
        return F.struct(state["first"].alias("first"), state["last"].alias("last"), F.array_append(state["done"], piece(state)).alias("pieces"))

    return F.aggregate(F.sort_array(F.collect_list(F.struct(*series.places))), start, step, finish)


def lowest_point(blocks: DataFrame, series: Series) -> DataFrame:
    """One row per piece with its lowest drawdown in ``_low``.

    ``blocks`` has ``_pieces`` per block; its other columns stay with the first piece of
    each block and are NULL on further ones, so that they can be aggregated per key.
    """
    others = [c for c in blocks.columns if c not in (*series.block_keys, "_pieces")]
    link = F.try_divide(F.col("_pieces.first"), F.lag("_pieces.last").over(series.over_blocks()))
    opened = blocks.withColumn("_link", link).select(*series.block_keys, *others, "_link", F.posexplode("_pieces.pieces").alias("_at", "_piece"))
    first = F.col("_at") == 0
    # without a link the first row is one more row without a factor
    turn = F.when(first, F.coalesce("_link", F.lit(1.0))).otherwise(F.col("_piece.turn"))
    before = Window.partitionBy(*series.keys).orderBy(BLOCK, "_at").rowsBetween(Window.unboundedPreceding, -1)
    entered = opened.withColumn("_turn", turn).withColumn(
        "_growth", F.coalesce(F.product(F.col("_turn") * F.col("_piece.product")).over(before), F.lit(1.0)) * F.col("_turn")
    )
    reached = entered.withColumn(
        "_peak", F.greatest(F.lit(1.0), F.max(F.col("_growth") * F.col("_piece.peak")).over(before))
    )
    growth, peak = F.col("_growth"), F.col("_peak")
    low = F.when(growth < 0, growth * F.col("_piece.peak") / peak).otherwise(
        F.least(growth * F.col("_piece.trough") / peak, F.col("_piece.fall"))
    )
    at_gap = F.lit(1.0) / F.greatest(peak, growth * F.col("_piece.gap"))
    at_start = F.when(first & F.col("_link").isNull(), F.lit(1.0) / peak)
    kept = [F.when(first, F.col(c)).alias(c) for c in others]
    lowest = F.least(low, F.when(F.col("_piece.gap").isNotNull(), at_gap), at_start) - F.lit(1.0)
    return reached.select(*series.keys, *kept, lowest.alias("_low"))
