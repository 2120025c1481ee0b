"""Documents joined by the Jaccard similarity of their word shingles (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import setjoin
from daybook.llm.arrowtext import grams, mix, signed, slices, words_of
from daybook.llm.graph import components
from daybook.llm.setjoin import ordered, prefix_length
from daybook.llm.tables import filter_slot, member_filter, only, stored, whole_row

SHINGLE = 5
#: Part of the hash range in which the document counts of shingles are taken; the
#: order prefers shingles of low hash, so few prefixes reach beyond it.
COUNTED = 0.4
_LIMIT = int(-(1 << 63) + COUNTED * (1 << 64))


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, at = words_of(column, lower=True)
    for i in range(len(column)):
        h = np.sort(signed(grams(words[at[i] : at[i + 1]], SHINGLE)))
        yield h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def _key(tokens: np.ndarray) -> int:
    """64-bit key of a whole set: equal sets, equal keys."""
    u = mix(tokens.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D))
    total = np.array([u.sum(dtype=np.uint64)]) + np.array([len(u)], dtype=np.uint64) * np.uint64(0x14057B7EF767814F)
    return int(signed(mix(total))[0])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [s[s < _LIMIT] for s in _sets(batch.column(0))]
        if found:
            token, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], names=["token", "n"])


def _prefixes(common):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = common.value
        for part in slices(batches):
            keys, sizes, prefixes = [], [], []
            for tokens in _sets(part.column("text")):
                n = len(tokens)
                sizes.append(n)
                keys.append(_key(tokens))
                prefixes.append(ordered(tokens, shared)[: prefix_length(n)] if n else tokens)
            ends = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "text_hash", "key", "n", "prefix"],
            )

    return run


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = list(_sets(part.column("text")))
        ends = np.cumsum([0] + [len(p) for p in found]).astype(np.int32)
        flat = np.concatenate(found) if found else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([_key(s) for s in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
            names=["key", "tokens"],
        )


def _verified(pairs: DataFrame, prefixes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of set keys whose whole sets reach the similarity."""
    pairs = stored(setjoin.bounded_pairs(pairs, prefixes), "bounded")
    sets = _sets_of(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), docs, classes)
    a = sets.select(F.col("key").alias("a"), F.col("tokens").alias("a_tokens"))
    b = sets.select(F.col("key").alias("b"), F.col("tokens").alias("b_tokens"))
    both = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return (
        pairs.join(b, "b").join(a, "a")
        .where(9 * both >= 4 * (F.size("a_tokens") + F.size("b_tokens")))
        .select("a", "b")
    )


def _sets_of(keys: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, tokens): the whole sets of the keys, from the texts of one document each."""
    wanted = stored(keys.join(classes, "key").select("rep"), "wanted")
    slots = docs.sparkSession.sparkContext.broadcast(np.flatnonzero(member_filter(wanted, "rep")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside = np.zeros(1 << 22, dtype=bool)
        inside[slots.value] = True
        for batch in batches:
            take = inside[batch.column("slot").to_numpy()]
            if take.any():
                yield batch.filter(pa.array(take)).select(["doc_id", "text"])

    few = docs.select("doc_id", "text", filter_slot("doc_id").alias("slot")).mapInArrow(chosen, "doc_id bigint, text string")
    texts = few.join(wanted.withColumnRenamed("rep", "doc_id"), "doc_id", "left_semi")
    # a document id that comes with several texts gives a set for each of them
    return stored(texts.mapInArrow(_whole_sets, "key bigint, tokens array<bigint>").dropDuplicates(["key"]), "sets")


def ngram_jaccard(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_key, component_key, component_id) per row.

    Texts are lower-cased (A-Z) and cut into words at space and 0x09-0x0D; a set is
    the distinct 5-word shingles, or the whole of a shorter text. Rows link when
    100 * intersection >= 80 * union; ``component_id`` is the smallest ``key``
    reachable. Rows of one ``set_key`` have equal sets, rows of one
    ``component_key`` are linked.

    Method: the sparse product of the document by shingle incidence with its own
    transpose, in two blocks of columns. The first holds the columns a size-derived
    bound makes necessary (the prefix of each row, common shingles last); overlaps
    are accumulated in it and pairs below the bound are discarded. The second block,
    all other columns, is only multiplied for the surviving pairs, and the whole
    overlap decides. Equal sets are one row of the matrix. Sets that a leader or a
    few neighbours join already are not paired with each other again; where a large
    group of near copies does not become one that way, the rest is multiplied with it
    in whole blocks inside the tasks, so its pairs are never rows (see ``setjoin``).

    Defined cases: NULL, empty and blank text: 0 shingles, component of its own
    ``key``. A NULL ``key``: sizes are given, links are not, ``component_id`` is NULL.
    Repeated rows are kept and share a component; a key with several texts has a row
    for each. Columns other than the two are not looked at. Shingles, and sets as
    keys, are compared by 64-bit hashes.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    counts = docs.select("text").mapInArrow(_counts, "token bigint, n bigint")
    common = spark.sparkContext.broadcast(setjoin.common_tokens(counts))
    rows = stored(docs.mapInArrow(_prefixes(common), "doc_id bigint, text_hash bigint, key bigint, n int, prefix array<bigint>"), "prefixes")
    known = rows.where("n > 0 and doc_id is not null")
    classes = stored(known.groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n")), "classes")

    prefixes = known.select("key", "n", "prefix")
    shared = setjoin.shared_tokens(prefixes, F.col("n"), "shared")
    tested = stored(setjoin.first_pairs(shared), "pairs")
    links = only(spark, "links", lambda: _verified(tested, prefixes, docs, classes))
    groups = components(links)
    apart = setjoin.apart(shared, groups)
    at_home = setjoin.homes(apart)
    within = only(spark, "links", lambda: setjoin.product_links(at_home, _sets_of(at_home.select("key"), docs, classes)))
    rest = stored(setjoin.remaining_pairs(apart, at_home, tested), "pairs")
    links = links.unionByName(within).unionByName(only(spark, "links", lambda: _verified(rest, prefixes, docs, classes)))
    groups = components(links)

    labelled = classes.join(groups.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "rep", F.coalesce("component", "key").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    resolved = labelled.join(smallest, "component").select("key", "component", "component_id")
    return rows.join(resolved, "key", "left").select(
        "doc_id",
        "text_hash",
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("key")).alias("set_key"),
        F.when(F.col("n") > 0, F.col("component")).alias("component_key"),
        F.when((F.col("n") == 0) | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_component(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Of each group of linked rows the one with the smallest ``key``, all columns.

    Rows without words link with nothing and stay, and so do rows with a NULL key.
    If the smallest key comes with several linked texts, the one of the smallest hash
    stays; of repeated rows one stays, by a hash of all its columns.
    """
    def linked() -> DataFrame:
        rows = ngram_jaccard(documents, text, key).where("component_key is not null and doc_id is not null")
        return rows.groupBy("doc_id", "text_hash", "component_key").agg(F.count(F.lit(1)).alias("copies"))

    found = only(documents.sparkSession, "found", linked)
    first = found.groupBy("component_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    ranked = found.join(first, "component_key").withColumn("stays", F.struct("doc_id", "text_hash") == F.col("first"))
    gone = stored(ranked.where(~F.col("stays")).select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")), "gone")
    again = stored(
        ranked.where("stays and copies > 1").select(F.col("doc_id").alias("again_id"), F.col("text_hash").alias("again_hash")), "again"
    )
    rows = documents.select(
        whole_row(documents).alias("row"), F.col(f"`{key}`").cast("bigint").alias("own_id"), F.xxhash64(F.col(f"`{text}`")).alias("own_hash")
    )
    kept = rows.join(gone, (F.col("own_id") == F.col("gone_id")) & (F.col("own_hash") == F.col("gone_hash")), "left_anti")
    if again.limit(1).count():
        repeated = (F.col("own_id") == F.col("again_id")) & (F.col("own_hash") == F.col("again_hash"))
        one = kept.join(again, repeated, "left_semi").groupBy("own_id", "own_hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        kept = kept.join(again, repeated, "left_anti").select("row").unionByName(one.select("row"))
    return kept.select("row.*")
