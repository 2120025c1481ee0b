"""The prefix trie of conversations and its subtree totals (operator 11).

A prefix is known by two 64-bit sums (exclusive or) over its turns, each hashed with its
place, so a node is found by grouping and needs no walk over levels. Subtree totals are
made by time-forward processing: nodes are sorted by reverse level order, each takes the
totals its children left for it in a priority queue, and leaves its own for its parent.

The trie is cut into shards that are complete between their top and their bottom. A
node's class is the power of ``WIDTH`` that its conversations reach, its band the
multiple of ``HEIGHT`` that its depth reaches; neighbours of one class and band are a
shard. Totals pass within shards first, all shards of a class and band at once, then
from the shard roots to the shards above.
"""

from __future__ import annotations

import heapq
import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.tables import stored
from daybook.operators.cuts import before_blocks, sampled_cuts

FAMILY = 100
INHERITED = 6
WIDTH = 1 << 16
HEIGHT = 1 << 16
#: Turns of a range where conversations are cut, see ``sampled_cuts``.
RANGE_TURNS = 1_000_000
#: Conversation ids joined into one text before the digest of a node.
ID_RANGE = 1024
#: Messages a queue keeps in memory before it writes them out in order.
IN_MEMORY = 200_000

NODE = ["depth", "k1", "k2"]


class MessageQueue:
    """Messages in the order of their receivers' places.

    Beyond ``most`` messages all are written, sorted, to an unnamed scratch file of the
    task in Spark's own spill folder, and merged from there; nothing else reads it, and
    a task that is run again starts anew.
    """

    def __init__(self, most: int = IN_MEMORY) -> None:
        self.most, self.heap, self.heads, self.runs = most, [], [], []

    def push(self, place: tuple, message: tuple) -> None:
        heapq.heappush(self.heap, (place, message))
        if len(self.heap) > self.most:
            self._spill()

    def take(self, place: tuple) -> Iterator[tuple]:
        """All messages for a place; places have to be asked for in order."""
        while self.heap and self.heap[0][0] == place:
            yield heapq.heappop(self.heap)[1]
        while self.heads and self.heads[0][0] == place:
            _, run, message = self.heads[0]
            self._advance(run)
            yield message

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
        file = tempfile.TemporaryFile(dir=folder if os.path.isdir(folder) else None)
        self.heap.sort()
        for item in self.heap:
            pickle.dump(item, file, protocol=5)
        file.seek(0)
        self.heap = []
        self.runs.append(file)
        place, message = pickle.load(file)
        heapq.heappush(self.heads, (place, len(self.runs) - 1, message))

    def _advance(self, run: int) -> None:
        try:
            place, message = pickle.load(self.runs[run])
        except EOFError:
            heapq.heappop(self.heads)
            self.runs[run].close()
        else:
            heapq.heapreplace(self.heads, (place, run, message))


def _numbered(conversations: DataFrame, range_turns: int) -> DataFrame:
    """(conv, block, nth, t1, t2, chars): turns with their place, from 1, as hashes.

    A block is a range of turns: a conversation with very many turns has several.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn"), role.alias("role"), text.alias("text"),
        F.substring(text, 1, 64).alias("start"),
    )
    cuts = sampled_cuts(turns, ["conv"], ["turn", "role", "start"], range_turns)
    in_order = Window.partitionBy("conv", "block").orderBy(F.asc_nulls_first("turn"), "role", "text")
    rows = cuts.place(turns, "block").select(
        "conv", "block", "turn", "role", "text",
        F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", F.lit(1), "role").alias("t2"), F.char_length("text").alias("chars"),
    ).withColumn("nth", F.row_number().over(in_order).cast("bigint")).select("conv", "block", "nth", "t1", "t2", "chars")
    if cuts.table is None:
        return stored(rows, "turns")
    rows = stored(rows, "turns")
    earlier = before_blocks(rows, ["conv"], "block", before=(F.count(F.lit(1)), "sum"))
    return rows.join(earlier, ["conv", "block"]).withColumn("nth", F.col("nth") + F.coalesce("before", F.lit(0))).drop("before")


def _prefixes(conversations: DataFrame, range_turns: int) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, chars): each prefix of each rebuilt conversation,
    with the sums of the prefix one shorter; the empty prefix has sums of zero."""
    turns = _numbered(conversations, range_turns)
    head, taken = F.col("conv") - F.col("conv") % FAMILY, F.crc32(F.col("conv").cast("string")) % INHERITED
    families = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("turns")).withColumns({"head": head, "taken": taken})
    first = turns.where((F.col("conv") % FAMILY == 0) & (F.col("nth") < INHERITED)).select(F.col("conv").alias("head"), "nth", "t1", "t2", "chars")
    inherited = families.join(first, "head").where(F.col("nth") <= F.col("taken")).select(
        "conv", F.lit(-1).cast("bigint").alias("block"), F.col("nth").alias("depth"), "t1", "t2", "chars"
    )
    there = first.groupBy("head").agg(F.count(F.lit(1)).alias("there"))
    own = turns.withColumns({"head": head, "taken": taken}).where(F.col("nth") > F.col("taken")).join(there, "head", "left")
    depth = F.col("nth") - F.col("taken") + F.least("taken", F.coalesce("there", F.lit(0)))
    own = own.select("conv", "block", depth.alias("depth"), "t1", "t2", "chars")

    cut = turns.select(F.max("block")).first()[0]
    block = F.col("block") if cut else F.lit(0).cast("bigint")
    rows = own.unionByName(inherited).withColumns(
        {"block": block, "x1": F.xxhash64("t1", "depth"), "x2": F.xxhash64("t2", "depth")}
    ).drop("t1", "t2")
    so_far = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({"k1": F.bit_xor("x1").over(so_far), "k2": F.bit_xor("x2").over(so_far)})
    if cut:
        summed = stored(summed, "sums")
        earlier = before_blocks(summed, ["conv"], "block", b1=(F.bit_xor("x1"), "bit_xor"), b2=(F.bit_xor("x2"), "bit_xor"))
        summed = summed.join(earlier, ["conv", "block"]).withColumns(
            {k: F.col(k).bitwiseXOR(F.coalesce(b, F.lit(0))) for k, b in (("k1", "b1"), ("k2", "b2"))}
        )
    zero = F.lit(0).cast("bigint")
    root = families.select("conv", *[zero.alias(c) for c in ("depth", "k1", "k2", "p1", "p2")], F.lit(0).alias("chars"))
    every = summed.select("conv", "depth", "k1", "k2", *[F.col(k).bitwiseXOR(F.col(x)).alias(p) for k, x, p in (("k1", "x1", "p1"), ("k2", "x2", "p2"))], "chars")
    return stored(every.unionByName(root), "prefixes")


def _ends(prefixes: DataFrame) -> DataFrame:
    """(node, n_ends, ends_sha256) of the nodes at which conversations end.

    The digest is over all ids of a node in order. They are sorted and joined in ranges
    first, so what a task reads one after the other for a node is a row for each range.
    """
    import hashlib

    last = prefixes.groupBy("conv").agg(F.max(F.struct(*NODE)).alias("node")).select("conv", "node.*")
    ids = F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string"))
    ranges = last.groupBy(*NODE, F.floor(F.col("conv") / ID_RANGE).alias("range")).agg(
        F.array_join(ids, ",").alias("ids"), F.count(F.lit(1)).alias("n")
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "n_ends", "ends_sha256"]
        at, n, sha = None, 0, None
        for batch in batches:
            done = []
            for *node, ids, count in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids", "n")], strict=True):
                if node != at:
                    if at:
                        done.append((*at, n, sha.hexdigest()))
                    at, n, sha = node, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
                n += count
            yield pa.RecordBatch.from_pylist([dict(zip(names, d, strict=True)) for d in done], schema)
        if at:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*at, n, sha.hexdigest()), strict=True))], schema)

    schema = pa.schema([*[(c, pa.int64()) for c in NODE], ("n_ends", pa.int64()), ("ends_sha256", pa.string())])
    in_order = ranges.repartition(*NODE).sortWithinPartitions(*NODE, "range")
    return in_order.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, n_ends bigint, ends_sha256 string")


def _power(n: str, base: int) -> Column:
    """0 up to ``base``, 1 up to its square, and so on."""
    levels, limit, out = [], base, F.lit(0)
    while limit < 1 << 62:
        levels.append(limit)
        limit *= base
    for limit in levels:
        out = out + (F.col(n) > limit).cast("int")
    return out


def _nodes(prefixes: DataFrame, width: int, height: int) -> DataFrame:
    """A row for each node: its parent, members, ends, class, band, and its shard's top."""
    band = F.floor(F.col("depth") / height).cast("bigint")
    grouped = stored(
        prefixes.groupBy(*NODE)
        .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
        .withColumns({"class": _power("n_convs", width), "band": band}),
        "grouped",
    )
    large = grouped.where("class > 0").select(*NODE, "class")
    tops = (
        prefixes.join(large, NODE, "left")
        .groupBy("conv", F.coalesce("class", F.lit(0)).alias("class"), band.alias("band"))
        .agg(F.min(F.struct(*NODE)).alias("top"))
    )
    parents = grouped.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv"))
    placed = grouped.join(parents, ["depth", "p1", "p2"], "left").join(_ends(prefixes), NODE, "left")
    return stored(placed.join(tops, ["conv", "class", "band"]).drop("p1", "p2", "k1", "k2"), "nodes", by=["class", "band"])


def _pass_up(in_memory: int):
    """Time-forward processing of a partition's shards, sorted by depth from the deepest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = MessageQueue(in_memory)
        for batch in batches:
            column = {c: batch.column(c).to_pylist() for c in ("conv", "depth", "parent_conv", "top_depth", "n_convs", "n_ends", "chars", "children", "leaves", "saved")}
            out = []
            for conv, depth, parent, top, n, ends, chars, children, leaves, saved in zip(*column.values(), strict=True):
                saved += (n - 1) * chars
                leaves += n == ends
                for below, kept in queue.take((-depth, conv)):
                    children, leaves, saved = children + 1, leaves + below, saved + kept
                if depth > top:
                    queue.push((1 - depth, parent), (leaves, saved))
                out.append((children, leaves, saved))
            totals = [pa.array([row[i] for row in out], pa.int64()) for i in range(3)]
            same = [batch.column(c) for c in ("conv", "depth", "parent_conv", "top_depth", "n_convs", "ends_sha256")]
            yield pa.RecordBatch.from_arrays(same + totals, names=["conv", "depth", "parent_conv", "top_depth", "n_convs", "ends_sha256", "children", "leaves", "saved"])

    return run


def prefix_trie(
    conversations: DataFrame, width: int = WIDTH, height: int = HEIGHT, range_turns: int = RANGE_TURNS, in_memory: int = IN_MEMORY
) -> DataFrame:
    """The nodes of the prefix trie of ``conversations(conv_id, turn, role, text)``.

    Conversations are ordered by turn, NULL first, equal turns by role and text. Every
    conv_id c is rebuilt from the first turns of conversation c - c % 100 and its own, as
    many as crc32(c) % 6 says. Returns (conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256) for every distinct prefix.

    Sizes: turns of a conversation are numbered and summed in ranges of ``range_turns``
    rows. Nodes come from partial aggregates; joins on nodes have one row per node on a
    side. A shard has at most ``height`` levels, each of at most ``width`` nodes apart
    from those of more conversations than that, and is read by one task as a stream. The
    rounds are one per class (a power of ``width``) and band present. The digest of a
    node's ids is one stream by its nature; it reads a row per 1,024 ids.

    Defined cases: rows without conv_id are left out. NULL role and text are empty.
    Repeated rows are turns each. The remainder of a negative id is negative, as in SQL.
    A conversation may have no turns after rebuilding; it
    ends at the root. Prefixes whose two 64-bit sums agree are taken as equal. An empty
    table gives no rows; other columns are not looked at.
    """
    nodes = _nodes(_prefixes(conversations, range_turns), width, height)
    rounds = sorted(nodes.select("class", "band").distinct().collect(), key=lambda r: (r["class"], -r["band"]))
    zero = F.lit(0).cast("bigint")
    done: list[DataFrame] = []
    for step in rounds:
        here = nodes.where((F.col("class") == step["class"]) & (F.col("band") == step["band"]))
        if done:
            here = here.join(_from_roots(done), ["conv", "depth"], "left")
            sums = {c: F.coalesce(c, zero) for c in ("children", "leaves", "saved")}
        else:
            sums = {c: zero for c in ("children", "leaves", "saved")}
        in_order = (
            here.withColumns(sums)
            .withColumns({"top_depth": F.col("top.depth"), "n_ends": F.coalesce("n_ends", zero), "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))})
            .repartition("top").sortWithinPartitions(F.desc("depth"), "conv")
        )
        schema = "conv bigint, depth bigint, parent_conv bigint, top_depth bigint, n_convs bigint, ends_sha256 string, children bigint, leaves bigint, saved bigint"
        done.append(stored(in_order.mapInArrow(_pass_up(in_memory), schema), "totals"))
    if not done:
        empty = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
        return conversations.sparkSession.createDataFrame([], empty)
    return _union(done).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), "ends_sha256",
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _from_roots(done: list[DataFrame]) -> DataFrame:
    """(conv, depth, children, leaves, saved): what the shard roots so far leave for
    their parents, summed per parent before it is moved."""
    roots = _union(done).where((F.col("depth") == F.col("top_depth")) & F.col("parent_conv").isNotNull())
    return roots.groupBy(F.col("parent_conv").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
