"""Sources mixed to target weights by a hypergeometric splitting tree (operator 7)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
#: Rows of a source in one block; a block is what shards draw and one window sorts.
BLOCK_ROWS = 1024
SHARDS = 16
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes(source_key, source_size, source_rows)`` with ``target`` and ``quota``.

    Sources in order of their key weigh 1, 2, 3 and so on again, and share the sum
    of all sizes by weight, up to MAX_REPEATS times their own. With sources ordered
    by cap / weight the level at which the rest shares is found from running sums.
    One row per source is windowed in one task.
    """
    by_key, by_cap = Window.orderBy("source_key"), Window.orderBy(F.col("cap") / F.col("weight"), "source_key")
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    capped = sizes.withColumn(
        "weight", F.element_at(weights, F.pmod(F.row_number().over(by_key) - 1, F.lit(len(WEIGHTS))) + 1).cast("bigint")
    ).withColumn("cap", MAX_REPEATS * F.col("source_size"))
    running = capped.select(
        "*",
        (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("left"),
        F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)).alias("left_weight"),
    )
    # the first source whose cap the level does not pass sets the level of all after it
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("left_weight")
    level = F.first(F.when(fits, F.struct("left", "left_weight")), ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, 0))
    target = F.coalesce((F.col("weight") * F.col("level.left")) / F.col("level.left_weight"), F.col("cap").cast("double"))
    return (
        running.withColumn("level", level).withColumn("target", target)
        .select("source_key", "source_size", "source_rows", "target", F.floor(F.col("target") + 0.5).cast("bigint").alias("quota"))
    )


def split_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(source_key, shard, k): exact block quotas ``quotas(source_key, k)`` dealt to shards.

    A node holds a run of shards and a quota per source. It gives its left half of
    the shards a multivariate-hypergeometric draw of its blocks, as many as that
    half's share, and the right half the rest, until each shard is a node. So every
    shard has the size it should, every source's blocks are all dealt, and each
    shard's blocks are a uniform draw without replacement. A node's quotas (a row per
    source) are split in one task; nodes of a level are split side by side.
    """
    schema = "low int, high int, source_key string, k bigint"

    def halves(nodes: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("source_key", ignore_index=True)
        low, high = int(nodes["low"].iloc[0]), int(nodes["high"].iloc[0])
        if high - low < 2:
            return nodes
        middle = (low + high) // 2
        k = nodes["k"].to_numpy(dtype=np.int64)
        take = round(int(k.sum()) * (middle - low) / (high - low))
        left = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(k, take, method="marginals")
        parts = [nodes.assign(high=middle, k=left), nodes.assign(low=middle, k=k - left)]
        out = pd.concat(parts, ignore_index=True)
        return out[out["k"] > 0]

    nodes = quotas.select(F.lit(0).alias("low"), F.lit(shards).alias("high"), "source_key", F.col("k").cast("bigint"))
    for _ in range(max(1, (shards - 1).bit_length())):
        nodes = nodes.groupBy("low", "high").applyInPandas(halves, schema)
    return nodes.select("source_key", F.col("low").alias("shard"), "k")


def mixture(
    documents: DataFrame, carry: Sequence[str] = ("doc_id",), key: str = "doc_id", text: str = "text", source: str = "source",
    shards: int = SHARDS, block_rows: int = BLOCK_ROWS, seed: int = SEED,
) -> DataFrame:
    """Per row of ``documents``: a struct ``row`` of the ``carry`` columns, then size,
    source_size, target, taken, and ``draws``: an array of (pass, shard, place, words).

    The rows of a source are put in an order by a hash of ``key`` and cut into blocks
    of that order. A source's quota (its rounded target) is met from the front, going
    through the source again, up to three times, where the target exceeds its size;
    so the words taken of a source are its quota exactly, and a row is taken at most
    three times. A row at the quota's end is taken for its first ``words`` words. The
    drawn blocks are dealt to the shards by ``split_quotas``: each shard gets a
    disjoint part of a permutation of them. ``place`` orders the rows of a shard.

    Sizes are word counts of whole texts. A source with most rows has most blocks;
    no window holds more than a block's rows or the blocks of a source.

    Defined cases: NULL and empty texts have size 0 and are never taken. A NULL
    source is a source of its own, ordered last. Rows with a NULL or repeated key are
    ordered by size and text next, so identical rows may swap. Tables without words
    take nothing. Carried columns may have any names.
    """
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("~")).alias("source_key"),
        word_count(F.col(text)).alias("size"), digest.alias("place"), F.xxhash64(F.col(text)).alias("tie"),
    )
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    sources = stored(source_targets(sizes), "sources")
    blocks_of = F.ceil(F.col("source_rows") / block_rows)
    hashed = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    rows = rows.join(sources.withColumn("blocks", blocks_of), "source_key").withColumn(
        "block", F.floor(hashed * F.col("blocks") / (1 << 32)).cast("bigint")
    )
    in_source = Window.partitionBy("source_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stored(
        rows.groupBy("source_key", "block").agg(
            F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("quota").alias("quota")
        ).withColumn("block_start", F.coalesce(F.sum("words").over(in_source), F.lit(0))),
        "blocks",
    )
    draws = blocks.select("*", F.explode(F.sequence(F.lit(0), F.lit(MAX_REPEATS - 1))).alias("pass")).where(
        (F.col("words") > 0) & (F.col("pass") * F.col("source_size") + F.col("block_start") < F.col("quota"))
    )
    permuted = Window.partitionBy("source_key").orderBy(
        F.md5(F.concat_ws("|", F.lit(seed), "source_key", "pass", "block")), "pass", "block"
    )
    draws = draws.select("source_key", "block", "pass", F.row_number().over(permuted).alias("at"))
    dealt = split_quotas(draws.groupBy("source_key").agg(F.count(F.lit(1)).alias("k")), shards, seed)
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    dealt = dealt.withColumn("from", F.coalesce(F.sum("k").over(before), F.lit(0)) + 1)
    dealt = dealt.select("source_key", "shard", F.explode(F.sequence(F.col("from").cast("int"), (F.col("from") + F.col("k") - 1).cast("int"))).alias("at"))
    # three at most per block
    of_block = draws.join(dealt, ["source_key", "at"]).groupBy("source_key", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("block_draws")
    )
    plan = stored(blocks.select("source_key", "block", "block_start").join(of_block, ["source_key", "block"], "left"), "draws")
    in_block = Window.partitionBy("source_key", "block").orderBy("place", "size", "tie").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("block_start") + F.col("before")
    draws_of_row = F.transform(
        F.coalesce("block_draws", F.array().cast("array<struct<pass:int,shard:int>>")),
        lambda d: F.struct(
            d["pass"].alias("pass"), d["shard"].alias("shard"), F.md5(F.concat_ws("|", "place", d["pass"])).alias("place"),
            F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - d["pass"] * F.col("source_size") - start)).alias("words"),
        ),
    )
    return (
        rows.withColumn("before", F.coalesce(F.sum("size").over(in_block), F.lit(0)))
        .join(plan, ["source_key", "block"])
        .select("row", "size", "source_size", "target", F.filter(draws_of_row, lambda d: d["words"] > 0).alias("draws"))
        .withColumn("taken", F.aggregate("draws", F.lit(0).cast("bigint"), lambda t, d: t + d["words"]))
    )


def mixed_documents(documents: DataFrame, **options) -> DataFrame:
    """The rows the mix takes, all columns of ``documents``, a row for each time taken.

    Only whole rows are given: the one row of a source at its quota's end comes once
    more if at least half of it is taken, else not.
    """
    mix = mixture(documents, documents.columns, **options)
    drawn = mix.select("row", "size", F.explode("draws").alias("draw")).where(2 * F.col("draw.words") >= F.col("size"))
    return drawn.select("row.*")


def write_shards(documents: DataFrame, path: str, **options) -> None:
    """The rows the mix takes in a folder per shard, shuffled inside it."""
    mix = mixture(documents, documents.columns, **options)
    drawn = mix.select("row", F.explode("draws").alias("draw"))
    # a shard is as many tasks as its rows need: a range of its places each
    placed = drawn.select(F.col("draw.shard").alias("mix_shard"), F.col("draw.place").alias("mix_place"), F.col("draw.words").alias("mix_words"), "row")
    placed.repartitionByRange("mix_shard", "mix_place").sortWithinPartitions("mix_shard", "mix_place").write.partitionBy("mix_shard").parquet(path)
