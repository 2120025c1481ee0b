"""Documents in byte-limited shards by extendible hashing (operator 9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.tables import stored

#: Bits of the hash looked at in one pass over the sizes.
STEP = 16
BITS = 60
LIMIT = 64 << 20


def hash_bits(key: Column) -> Column:
    """60 bits of the key's MD5; NULL hashes like an empty key."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("bigint")


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def own_bits(text: Column, row: Column) -> Column:
    """60 bits for rows of one key: 30 of the text's MD5, then 30 of the row number's."""
    half = BITS // 8
    parts = (F.md5(F.coalesce(text.cast("string"), F.lit(""))), F.md5(row.cast("string")))
    digits = F.concat(F.substring(parts[0], 1, half), F.substring(parts[1], 1, BITS // 4 - half))
    return F.conv(digits, 16, 10).cast("bigint")


def directory(sizes: DataFrame, limit: int = LIMIT, root: tuple[str, ...] = ()) -> DataFrame:
    """(depth, prefix, bytes, rows) of the buckets of ``sizes(bits, bytes)``.

    Splitting starts with one bucket at depth 0. A bucket over the limit splits on
    the next hash bit; one within it is final. Sizes are summed per prefix of sixteen
    more bits at a time, so a pass over the rows serves sixteen levels of splits, and
    only the rows of buckets still too large are summed again. Rows whose whole hash
    is equal stay one bucket here, whatever its size. With columns ``root`` each of
    their values has buckets of its own.
    """
    final, base = None, 0
    cells = sizes.select(*root, "bits", F.col("bytes"), F.lit(1).cast("bigint").alias("rows"))
    while True:
        deep = min(base + STEP, BITS)
        fine = stored(
            cells.groupBy(*root, F.shiftright("bits", BITS - deep).alias("cell")).agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")),
            "cells",
        )
        # every level of this step from one explode: the cell's prefixes at depths base..deep
        levels = fine.select(
            *root, F.explode(F.sequence(F.lit(base if base == 0 else base + 1), F.lit(deep))).alias("depth"), "cell", "bytes", "rows"
        ).select(*root, "depth", F.expr(f"shiftright(cell, {deep} - depth)").alias("prefix"), "bytes", "rows")
        sums = levels.groupBy(*root, "depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        sums = stored(sums, "levels")
        parent = sums.where(F.col("bytes") > limit).select(
            *root, (F.col("depth") + 1).alias("depth"), F.explode(F.array(F.col("prefix") * 2, F.col("prefix") * 2 + 1)).alias("prefix")
        )
        done = F.lit(True) if deep == BITS else F.lit(False)
        first = base if base == 0 else base + 1  # roots of this step; their parents were too large
        reached = sums.where(F.col("depth") == first).unionByName(sums.where(F.col("depth") > first).join(parent, [*root, "depth", "prefix"], "left_semi"))
        ended = reached.where((F.col("bytes") <= limit) | (done & (F.col("depth") == deep)))
        final = ended if final is None else final.unionByName(ended)
        if deep == BITS:
            return stored(final, "directory")
        over = stored(sums.where((F.col("depth") == deep) & (F.col("bytes") > limit)).select(*root, F.col("prefix").alias("cell")), "over")
        if over.limit(1).count() == 0:
            return stored(final, "directory")
        cells = cells.withColumn("cell", F.shiftright("bits", BITS - deep)).join(over, [*root, "cell"], "left_semi").drop("cell")
        base = deep


def sharded(documents: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, into: str = "shard") -> DataFrame:
    """``documents`` with a struct ``into``: id, depth, bytes of the row, shard_bytes, shard_rows.

    ``id`` is the bucket's hash prefix as a string of bits, so it names the bucket at
    any later split. The bits are 60 of the key. Where rows of one key's bits are over
    the limit, 30 bits of the text and 30 of the row's number in a stored copy of those
    rows follow, so that only a single text over the limit can exceed it. (Two rows
    that agree in all 120 bits would stay together; the numbers differ.)

    Each row finds its bucket by the directory: its first sixteen bits give the depth
    (or the few depths, where splitting went on), and with it the prefix to look up.

    Defined cases: NULL and empty texts count 0 bytes; NULL keys hash like an empty
    key and share buckets with it as far as they fit, and so do repeated rows. Which
    of several rows of equal key and text goes to which shard is not defined beyond
    the key's and text's bits. An empty table has no shards. If a column has the name
    ``into``, underscores are appended to it.
    """
    taken = {c.lower() for c in documents.columns}
    while into.lower() in taken:
        into += "_"
    sizes = documents.select(hash_bits(F.col(key)).alias("bits"), row_bytes(F.col(text)).alias("bytes"))
    buckets = directory(sizes, limit)
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), hash_bits(F.col(key)).alias("bits"), row_bytes(F.col(text)).alias("own")
    ).withColumn("cell", F.shiftright("bits", BITS - STEP))
    crowded = stored(buckets.where((F.col("depth") == BITS) & (F.col("bytes") > limit) & (F.col("rows") > 1)).select(F.col("prefix").alias("bits")), "crowded")
    placed = (
        rows.join(F.broadcast(_index(buckets)), "cell")
        .select("row", "bits", "own", F.explode("depths").alias("depth"))
        .withColumn("prefix", F.expr(f"shiftright(bits, {BITS} - depth)"))
        .join(buckets, ["depth", "prefix"])
    )
    name = _bit_string("prefix", "depth")
    found = [(placed, name, F.col("depth"))]
    if crowded.limit(1).count():
        within = F.col("depth") < BITS
        placed = placed.where(within).unionByName(placed.where(~within).join(crowded, "bits", "left_anti").select(*placed.columns))
        heavy = rows.join(crowded, "bits", "left_semi").select("row", F.col("bits").alias("key_bits"), "own")
        heavy = stored(heavy.withColumn("number", F.monotonically_increasing_id()), "heavy")
        heavy = heavy.withColumn("bits", own_bits(F.col("row")[text], F.col("number")))
        parts = directory(heavy.select("key_bits", "bits", F.col("own").alias("bytes")), limit, ("key_bits",))
        depths = parts.groupBy("key_bits").agg(F.collect_set("depth").alias("depths"))
        split = (
            heavy.join(depths, "key_bits")
            .select("row", "key_bits", "bits", "own", F.explode("depths").alias("depth"))
            .withColumn("prefix", F.expr(f"shiftright(bits, {BITS} - depth)"))
            .join(parts, ["key_bits", "depth", "prefix"])
        )
        whole = F.lpad(F.bin("key_bits"), BITS, F.lit("0"))
        found = [(placed, name, F.col("depth")), (split, F.concat(whole, name), F.col("depth") + BITS)]
    shards = [
        frame.select("row.*", F.struct(
            id_.alias("id"), depth.alias("depth"), F.col("own").alias("bytes"), F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows"),
        ).alias(into))
        for frame, id_, depth in found
    ]
    return shards[0] if len(shards) == 1 else shards[0].unionAll(shards[1])


def _bit_string(prefix: str, depth: str) -> Column:
    return F.when(F.col(depth) == 0, "").otherwise(F.lpad(F.bin(prefix), F.col(depth), F.lit("0")))


def _index(buckets: DataFrame) -> DataFrame:
    """(cell, depths) for each value of the first sixteen bits: 65,536 rows at most.

    A cell inside one bucket has that bucket's depth; a cell that was split further
    has the depths of its buckets, of which one has the row's prefix.
    """
    whole = buckets.where(F.col("depth") <= STEP).select(
        F.explode(F.expr(
            f"sequence(shiftleft(prefix, {STEP} - depth), shiftleft(prefix + 1, {STEP} - depth) - 1)"
        )).alias("cell"), "depth",
    )
    split = buckets.where(F.col("depth") > STEP).select(F.expr(f"shiftright(prefix, depth - {STEP})").alias("cell"), "depth")
    return whole.unionByName(split).groupBy("cell").agg(F.collect_set("depth").alias("depths"))
