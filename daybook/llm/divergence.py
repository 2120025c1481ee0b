"""How the sources of each language differ in their words (operator 13).

Words are counted per (lang, source) in Spark. For the sums over whole vocabularies the
vocabulary is reordered so that words with equal counts lie together; a group's counts
are then a column of runs, and two groups are compared run by run: where their run
bounds are intersected both counts are constant, so the difference is worked out once
and multiplied by the run's length. The vocabulary is dealt out in ranges of that
order, each range gives a partial sum for each pair, so no task sees all words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.arrowtext import buffers, slices, spans
from daybook.llm.tables import stored
from daybook.operators.cuts import sampled_cuts

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
#: Distinct lists of counts in a range of the reordered vocabulary.
RANGE_WORDS = 100_000
#: Bytes of text whose words are counted together, or one text.
TOGETHER = 8 << 20

_OTHER = np.ones(256, dtype=bool)
_OTHER[ord("A") : ord("Z") + 1] = _OTHER[ord("a") : ord("z") + 1] = _OTHER[0x80:] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def batch_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, each word's place among them, its row) of a text column."""
    data, offsets = buffers(column)
    starts, ends = spans(data, offsets, _OTHER)
    at = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int64)
    letters = _LOWER[data[~_OTHER[data]]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(letters)).dictionary_encode()
    return words.dictionary, words.indices.to_numpy().astype(np.int64), np.searchsorted(offsets, starts, side="right") - 1


def batch_counts(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """(lang, source, term, n, documents) of some documents."""
    langs, sources = (c.dictionary_encode() for c in (lang, source))
    wide = len(sources.dictionary)
    group = langs.indices.to_numpy().astype(np.int64) * wide + sources.indices.to_numpy()
    groups, group = np.unique(group, return_inverse=True)
    terms, codes, rows = batch_terms(text)
    size = max(len(terms), 1)
    in_row, n = np.unique(rows * size + codes, return_counts=True)
    row, code = in_row // size, in_row % size
    keys, where = np.unique(group[row] * size + code, return_inverse=True)
    which = groups[keys // size]
    return pa.RecordBatch.from_arrays(
        [
            langs.dictionary.take(pa.array(which // wide)),
            sources.dictionary.take(pa.array(which % wide)),
            terms.take(pa.array(keys % size)).cast(pa.string()),
            pa.array(_sums(where, n, len(keys))),
            pa.array(np.bincount(where, minlength=len(keys)).astype(np.int64)),
        ],
        names=["lang", "source", "term", "n", "documents"],
    )


def _sums(where: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, dtype=np.int64)
    np.add.at(out, where, n)
    return out


def term_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences, and documents with the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, most=TOGETHER):
            yield batch_counts(*part.columns)

    counted = documents.select(*_texts("lang", "source", "text")).mapInArrow(
        run, "lang string, source string, term string, n bigint, documents bigint"
    )
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


def _texts(*columns: str) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns]


def kept_terms(counts: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term, total, counts) of the words that enough documents of a language have;
    ``counts`` holds a (source, n) for each source with the word, by source."""
    return (
        counts.groupBy("lang", "term")
        .agg(
            F.sum("documents").alias("documents"),
            F.sum("n").alias("total"),
            F.sort_array(F.collect_list(F.struct("source", "n"))).alias("counts"),
        )
        .where(F.col("documents") >= least)
        .drop("documents")
    )


def runs(rows: np.ndarray, counts: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, counts) of a group's runs from its entries.

    Entry i says that the words from ``bounds[rows[i]]`` to ``bounds[rows[i] + 1]`` have
    ``counts[i]`` each; all others have none. Neighbours of equal count are one run.
    """
    gap = np.append(rows[1:] != rows[:-1] + 1, rows[-1] + 1 < len(bounds) - 1) if len(rows) else np.zeros(0, dtype=bool)
    starts = np.concatenate((bounds[rows], bounds[rows[gap] + 1]))
    values = np.concatenate((counts, np.zeros(int(gap.sum()), dtype=np.int64)))
    if len(rows) == 0 or rows[0] > 0:
        starts, values = np.append(starts, 0), np.append(values, 0)
    order = np.argsort(starts, kind="stable")
    starts, values = starts[order], values[order]
    new = np.append(True, values[1:] != values[:-1])
    return starts[new], values[new]


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), exact for counts of any size."""
    distinct, where = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (int(c) + 1) // total for c in distinct], dtype=np.int64)[where]


def pair_sums(columns: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    """Sum of floor((p - q)^2 / q) over all words for each ordered pair of columns.

    A column is (run starts, p of each run). The sums fit into 64 bits: shares add up
    to no more than SCALE plus the number of words.
    """
    out = np.zeros((len(columns), len(columns)), dtype=np.int64)
    for a, (first, p) in enumerate(columns):
        for b in range(a):
            second, q = columns[b]
            both = np.sort(np.concatenate((first, second)))
            both = both[np.append(True, both[1:] != both[:-1])]
            long = np.diff(np.append(both, words))
            p_here = p[np.searchsorted(first, both, side="right") - 1]
            q_here = q[np.searchsorted(second, both, side="right") - 1]
            apart = (p_here - q_here) ** 2
            out[a, b] = (apart // q_here * long).sum()
            out[b, a] = (apart // p_here * long).sum()
    return out


def _pair_values(terms: DataFrame, totals: dict[str, dict[str, int]], range_words: int) -> DataFrame:
    """(lang, source, item, value) of the pairs of each language, from partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").dictionary_encode()
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                part = batch.filter(pa.array(langs.indices.to_numpy() == code))
                sums[lang] = sums.get(lang, 0) + _one_range(part, totals[lang])
        for lang, table in sums.items():
            names = list(totals[lang])
            size = len(names)
            every = pa.array(names, pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size**2, pa.string()),
                    every.take(pa.array(np.repeat(np.arange(size), size))),
                    every.take(pa.array(np.tile(np.arange(size), size))),
                    pa.array(table.reshape(-1), pa.int64()),
                ],
                names=["lang", "source", "item", "value"],
            )

    alike = stored(terms.groupBy("lang", "counts").agg(F.count(F.lit(1)).alias("words")), "alike-words")
    cuts = sampled_cuts(alike, ["lang"], ["counts"], range_words)
    in_order = cuts.place(alike, "range").repartition("lang", "range").sortWithinPartitions("lang", "range", "counts").drop("range")
    partial = in_order.mapInArrow(run, "lang string, source string, item string, value bigint")
    return partial.groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value"))


def _one_range(part: pa.RecordBatch, totals: dict[str, int]) -> np.ndarray:
    """``pair_sums`` of some neighbours in the reordered vocabulary of a language."""
    bounds = np.concatenate(([0], np.cumsum(part.column("words").to_numpy())))
    lists = part.column("counts")
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
    entries = lists.flatten()
    place = {name: i for i, name in enumerate(totals)}
    names = entries.field("source").dictionary_encode()
    source = np.array([place[n] for n in names.dictionary.to_pylist()], dtype=np.int64)[names.indices.to_numpy()]
    n = entries.field("n").to_numpy()
    order = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[order], np.arange(len(totals) + 1))
    columns = []
    for i, total in enumerate(totals.values()):
        own = order[ends[i] : ends[i + 1]]
        starts, counts = runs(rows[own], n[own], bounds)
        columns.append((starts, shares(counts, total)))
    return pair_sums(columns, int(bounds[-1]))


def _share(count: str, total: str) -> str:
    return f"(1 + CAST({SCALE} AS DECIMAL(20,0)) * CAST({count} + 1 AS DECIMAL(20,0)) div CAST({total} AS DECIMAL(20,0)))"


def _term_values(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    each = terms.select("lang", "term", "total", F.inline("counts")).join(groups, ["lang", "source"])
    told = each.selectExpr("lang", "source", "term AS item", f"{_share('n', 'group_total')} AS p", f"{_share('total', 'lang_total')} AS q")
    valued = told.where("p > q").selectExpr("lang", "source", "'term' AS part", "item", "((p - q) * (p - q)) div q AS value")
    return valued.withColumn("rank", _rank()).where(F.col("rank") <= top)


def _rank() -> Column:
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))


def source_divergence(documents: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP_TERMS, range_words: int = RANGE_WORDS) -> DataFrame:
    """(lang, source, part, item, value, rank) of each (lang, source) of ``documents``.

    A language keeps the words in at least ``least`` of its documents. A kept word's
    share is p = 1 + floor(SCALE * (count + 1) / (N + V)); N is the group's count of kept
    words, V their number. Part ``pair`` has a row for each other source of the language,
    with the sum of floor((p - q)^2 / q) over all kept words, q the other's share. Part
    ``term`` has the ``top`` words that the group uses more than the language, with that
    term, q the language's share. All arithmetic is exact.

    Sizes: the number of (lang, source) groups is known to the driver and sent to the
    tasks, a row each, as the result has a row for each pair of them; a word has a list
    of at most one entry per source. Words are never all in one place: they are counted
    per batch, then per task, then by key, and dealt out in ranges for the sums.

    Defined cases: NULL lang, source and text are ''. Repeated rows are documents each.
    Groups without words are there, with count 0 for all words; a language without kept
    words has pairs of value 0 and no words. Equal values rank by item. An empty table
    gives no rows; other columns are not looked at.
    """
    documents = documents.select(*_texts("lang", "source", "text"))
    terms = stored(kept_terms(term_counts(documents), least), "kept-terms")
    named = documents.select("lang", "source").distinct()
    per_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("n"))
    per_group = terms.select("lang", F.inline("counts")).groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = stored(
        named.join(per_lang, "lang", "left").join(per_group, ["lang", "source"], "left").select(
            "lang", "source",
            (F.coalesce("own", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("group_total"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("v", F.lit(0))).alias("lang_total"),
        ),
        "groups",
    )
    totals: dict[str, dict[str, int]] = {}
    for row in groups.orderBy("lang", "source").collect():
        totals.setdefault(row["lang"], {})[row["source"]] = row["group_total"]

    other = groups.select("lang", F.col("source").alias("item"))
    pairs = groups.select("lang", "source").join(other, "lang").where(F.col("source") != F.col("item"))
    summed = pairs.join(_pair_values(terms, totals, range_words), ["lang", "source", "item"], "left")
    valued = summed.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("bigint").alias("value"))
    ranked = valued.withColumn("rank", _rank())
    return ranked.unionByName(_term_values(terms, groups, top))
