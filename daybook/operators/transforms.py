"""A caller's own transform along a series, aligned with its rows.

A transform that carries a state from row to row would have to read a series from its
start. It is given in three parts instead, so that blocks are worked on side by side:
what a block does to any state (``summarize``), how a state passes over such a summary
(``advance``), and the rows of a block for a known state (``transform``). Summaries are
a row per block; the states are found by passing over them, and joined to the blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.operators.blocks import BLOCK, Series, with_block
from daybook.operators.series import PRICE_SERIES


def carried_transform(
    rows: DataFrame,
    summarize: Callable[[pd.DataFrame], dict],
    summary: str,
    advance: Callable[[dict, dict], dict],
    start: dict,
    state: str,
    transform: Callable[[dict, pd.DataFrame], pd.DataFrame],
    result: str,
    series: Series = PRICE_SERIES,
) -> DataFrame:
    """``rows`` with the ``result`` columns that ``transform`` gives for each.

    ``summarize`` turns a block of rows, in order, into one row of ``summary``;
    ``advance`` gives the ``state`` after a block from the state before and its summary,
    beginning with ``start``; ``transform`` gives the result columns of a block, aligned
    with its rows, from the state before it. A worker holds one block at a time, or the
    summaries of one key. Rows without key or position are left out.
    """
    order = series.places
    summary_fields, state_fields, result_fields = (T.StructType.fromDDL(d).fields for d in (summary, state, result))
    blocked = with_block(rows, series)
    block_fields = [blocked.schema[c] for c in series.block_keys]
    # workers get plain names, so executors need no copy of this package
    block_keys, number = series.block_keys, BLOCK
    names, given = [f.name for f in state_fields], [f.name for f in (*blocked.schema.fields, *result_fields)]

    def in_order(block: pd.DataFrame) -> pd.DataFrame:
        return block.sort_values(order, kind="stable", na_position="first").reset_index(drop=True)

    def one_block(group: tuple, block: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([dict(zip(block_keys, group, strict=True)) | summarize(in_order(block))])

    def one_key(group: tuple, summaries: pd.DataFrame) -> pd.DataFrame:
        now, out = start, []
        for told in summaries.sort_values(number).to_dict("records"):
            out.append(dict(zip(block_keys, (*group, told[number]), strict=True)) | now)
            now = advance(now, told)
        return pd.DataFrame(out, columns=[*block_keys, *names])

    def apply(block: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        if block.empty:
            return pd.DataFrame(columns=given)
        block, now = in_order(block), states[names].to_dict("records")[0]
        return pd.concat([block, transform(now, block).reset_index(drop=True)], axis=1)

    summaries = blocked.select(*dict.fromkeys([*series.block_keys, *order])).groupBy(*series.block_keys).applyInPandas(
        one_block, T.StructType([*block_fields, *summary_fields])
    )
    entering = summaries.groupBy(*series.keys).applyInPandas(one_key, T.StructType([*block_fields, *state_fields]))
    return (
        blocked.groupBy(*series.block_keys)
        .cogroup(entering.groupBy(*series.block_keys))
        .applyInPandas(apply, T.StructType([*blocked.schema.fields, *result_fields]))
        .drop(BLOCK)
    )


def exponential_mean(rows: DataFrame, span: float, series: Series = PRICE_SERIES, name: str = "ewm") -> DataFrame:
    """The exponentially weighted mean, ``mean += (value - mean) * 2 / (span + 1)``.

    It begins at the first value present; a missing value leaves the mean as it is, and
    there is none before the first value. A block maps the mean before it to
    ``keep * mean + add``.
    """
    weight, value = 2.0 / (span + 1.0), series.value

    def summarize(block: pd.DataFrame) -> dict:
        present = block[value].dropna().to_numpy(dtype=float)
        keep, add = 1.0, 0.0
        for x in present:
            keep, add = keep * (1 - weight), add * (1 - weight) + x * weight
        return {"first": float(present[0]) if len(present) else None, "keep": keep, "add": add}

    def advance(state: dict, block: dict) -> dict:
        mean = block["first"] if state["mean"] is None or pd.isna(state["mean"]) else state["mean"]
        return {"mean": None if mean is None or pd.isna(mean) else block["keep"] * mean + block["add"]}

    def transform(state: dict, block: pd.DataFrame) -> pd.DataFrame:
        mean, out = state["mean"], []
        for x in block[value].to_numpy(dtype=float):
            if x == x:
                mean = x if mean is None or mean != mean else mean + (x - mean) * weight
            out.append(mean)
        return pd.DataFrame({name: pd.array(out, dtype="Float64")})

    return carried_transform(
        rows, summarize, "first double, keep double, add double", advance, {"mean": None}, "mean double", transform, f"{name} double", series
    )

