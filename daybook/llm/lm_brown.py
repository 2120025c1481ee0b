"""Texts scored by a Brown class bigram model learned from the corpus (operator 5)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrowtext import buffers, signed, slices, spans, word_hashes
from daybook.llm.tables import commonest, stored

FOLDS = 10
ADD = 0.1
#: Most frequent words that are exchanged between classes in rounds, and the classes.
#: All other training words join the class that suits their contexts best, see ``learn``.
CLUSTERED = 4096
CLASSES = 48
#: Until then they are told apart by their length in bytes, up to this.
LENGTHS = 16
END_CLASS = CLASSES + LENGTHS
START_CLASS = END_CLASS + 1
ALL_CLASSES = START_CLASS + 1
#: Weight of the class unigram in a transition, in observations.
BACKOFF = 20.0
ROUNDS = 6
BUCKETS = 32
#: Words whose counts and classes every task has (24 bytes each); those of all others
#: are joined. Results do not depend on it.
LOOKUP = 1 << 18
PAIRS = ALL_CLASSES * ALL_CLASSES
CODES = (LENGTHS + 1) * PAIRS
#: So many contexts of words are compared with all classes at a time (384 bytes each).
CONTEXTS = 1 << 15
_END = np.int64(0x0E0D0E0D0E0D0E0D)


@dataclass
class Tokens:
    """All tokens of some texts, an end token after each; words by hash."""

    hashes: np.ndarray
    length: np.ndarray
    first: np.ndarray  # index of each text's first token

    @staticmethod
    def of(column: pa.Array) -> Tokens:
        data, offsets = buffers(column)
        starts, ends = spans(data, offsets)
        at = np.searchsorted(starts, offsets)
        texts = len(column)
        words = at[-1] if texts else 0
        text_of = np.repeat(np.arange(texts), np.diff(at))
        hashes = np.full(words + texts, _END, dtype=np.int64)
        length = np.zeros(words + texts, dtype=np.int64)
        place = np.arange(words) + text_of
        hashes[place] = signed(word_hashes(data, starts, ends, lower=True))
        length[place] = np.minimum(ends - starts, LENGTHS)
        return Tokens(hashes, length, at[:-1] + np.arange(texts))


def _find(known: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index in the sorted ``known`` of each wanted value, or -1."""
    if len(known) == 0:
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return np.where(known[at] == wanted, at, -1)


def _units(tokens: Tokens, clustered: np.ndarray) -> np.ndarray:
    """A clustered word's index; for other words, the end and the start, what follows."""
    at = _find(clustered, tokens.hashes)
    other = np.where(tokens.hashes == _END, LENGTHS, tokens.length - 1) + len(clustered)
    return np.where(at >= 0, at, other)


def _before(tokens: Tokens, values: np.ndarray, start: int) -> np.ndarray:
    """The value of the token before each token; ``start`` at the start of a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[tokens.first] = start
    return out


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        tokens = Tokens.of(batch.column(0))
        word, n = np.unique(tokens.hashes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], names=["word", "n"])


def _pair_counts(clustered):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = clustered.value
        width = len(known) + LENGTHS + 2
        for batch in slices(batches):
            tokens = Tokens.of(batch.column(0))
            units = _units(tokens, known)
            pairs, n = np.unique(_before(tokens, units, width - 1) * width + units, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs // width), pa.array(pairs % width), pa.array(n)], names=["a", "b", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def _best_class(matrix: np.ndarray, own: int, right: np.ndarray, left: np.ndarray, twice: float) -> int:
    """The class an exchange of one word gains most by, all other words staying.

    ``right`` and ``left`` are the word's counts with the classes after and before
    it, without its pairs with itself (``twice``). The gain is the change of the
    class bigram log likelihood, exact.
    """
    m = matrix.copy()
    m[own, :] -= right
    m[:, own] -= left
    m[own, own] -= twice
    m = np.maximum(m, 0)
    c = CLASSES
    rows = _xlogx(m[:c] + right) - _xlogx(m[:c])
    columns = (_xlogx(m[:, :c] + left[:, None]) - _xlogx(m[:, :c])).T
    at = np.arange(c)
    gain = rows.sum(1) + columns.sum(1) - rows[at, at] - columns[at, at]
    corner = m[at, at]
    gain += _xlogx(corner + right[:c] + left[:c] + twice) - _xlogx(corner)
    out, into = m.sum(1)[:c], m.sum(0)[:c]
    gain -= _xlogx(out + right.sum() + twice) - _xlogx(out) + _xlogx(into + left.sum() + twice) - _xlogx(into)
    best = int(gain.argmax())
    return best if gain[best] > gain[own] + 1e-9 else own


def _class_matrix(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Class bigram counts: the driver gets a row per class pair."""
    table = pairs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ALL_CLASSES, ALL_CLASSES))
        for batch in batches:
            a, b, n = (batch.column(i).to_numpy() for i in range(3))
            np.add.at(total, (table.value[a], table.value[b]), n)
        a, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(total[a, b])], names=["a", "b", "n"])

    found = pairs.mapInArrow(run, "a bigint, b bigint, n double").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros((ALL_CLASSES, ALL_CLASSES))
    matrix[found.column("a").to_numpy(), found.column("b").to_numpy()] = found.column("n").to_numpy()
    return matrix


def _likelihood(matrix: np.ndarray) -> float:
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def _exchanged(state, turn: int):
    """The moves of a bucket of words in one round."""
    def exchanged(rows: pd.DataFrame) -> pd.DataFrame:
        classes, matrix = state.value
        unit = np.unique(rows["unit"].to_numpy())
        at = np.searchsorted(unit, rows["unit"].to_numpy())
        counts = np.zeros((len(unit), 2, ALL_CLASSES))
        other, side, n = rows["other"].to_numpy(), rows["side"].to_numpy(), rows["n"].to_numpy()
        self_pair = other == rows["unit"].to_numpy()
        np.add.at(counts, (at[~self_pair], side[~self_pair], classes[other[~self_pair]]), n[~self_pair])
        twice = np.zeros(len(unit))
        mine = self_pair & (side == 0)
        np.add.at(twice, at[mine], n[mine])
        moves = [
            (u, _best_class(matrix, classes[u], counts[i, 0], counts[i, 1], twice[i]))
            for i, u in enumerate(unit) if (u // BUCKETS + turn) % 2 == 0
        ]
        return pd.DataFrame(moves, columns=["unit", "to"]).astype("int64")

    return exchanged


def exchange_classes(pairs: DataFrame, start: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """(class of each unit, class bigram counts) from ``pairs(a, b, n)`` of units.

    ``start`` has the words' first classes. In a round every second word
    (by turns) is offered its best exchange against the classes of the last round;
    the words are evaluated side by side in Spark, in buckets. A round that lowers
    the likelihood is undone and ends it.
    """
    fixed = np.concatenate((np.arange(CLASSES, END_CLASS), [END_CLASS, START_CLASS]))
    words, classes = len(start), np.concatenate((start, fixed)).astype(np.int64)
    matrix = _class_matrix(pairs, classes)
    spark = pairs.sparkSession
    sides = pairs.select(F.col("a").alias("unit"), F.col("b").alias("other"), F.lit(0).alias("side"), "n").unionByName(
        pairs.select(F.col("b").alias("unit"), F.col("a").alias("other"), F.lit(1).alias("side"), "n")
    )
    sides = stored(sides.where(F.col("unit") < words).withColumn("bucket", F.pmod("unit", F.lit(BUCKETS))), "contexts")
    for turn in range(rounds):
        state = spark.sparkContext.broadcast((classes, matrix))

        moved = sides.groupBy("bucket").applyInPandas(_exchanged(state, turn), "unit bigint, to bigint").toArrow()
        after = classes.copy()
        after[moved.column("unit").to_numpy()] = moved.column("to").to_numpy()
        if (after == classes).all():
            if turn % 2:
                break
            continue
        changed = _class_matrix(pairs, after)
        if _likelihood(changed) < _likelihood(matrix):
            break
        classes, matrix = after, changed
    return classes, matrix


def _contexts(state):
    """(word, code, n) of the words that are not clustered: how often two classes are around them.

    The code is (length, class before, class after).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes = state.value
        for batch in slices(batches):
            tokens = Tokens.of(batch.column(0))
            units = _units(tokens, known)
            c = classes[units]
            at = np.flatnonzero((units >= len(known)) & (tokens.hashes != _END))
            hashes, before = tokens.hashes[at], _before(tokens, c, START_CLASS)[at]
            word = np.unique(hashes)
            row = np.searchsorted(word, hashes)
            code = (tokens.length[at] * ALL_CLASSES + before) * ALL_CLASSES + c[at + 1]
            found, n = np.unique(row * CODES + code, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word[found // CODES]), pa.array((found % CODES).astype(np.int32)), pa.array(n)], names=["word", "code", "n"]
            )

    return run


def _sides(row: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, n) of each side, in order: code is the class after a word, or ALL_CLASSES + the class before it."""
    width = 2 * ALL_CLASSES
    after, before = code % ALL_CLASSES, code // ALL_CLASSES % ALL_CLASSES
    key = np.concatenate((row * width + after, row * width + ALL_CLASSES + before))
    order = np.argsort(key)
    key, n = key[order], np.concatenate((n, n))[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    key = key[first]
    return key // width, key % width, np.add.reduceat(n, first) if len(first) else n


def _joined_classes(matrix: np.ndarray, row: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class, count) of words that join the class they gain most by.

    ``row``, ascending from 0, is the word of each context, ``code`` its side and
    class. The gain is the change of the class bigram log likelihood when the word's
    pairs are added to ``matrix``; of equal gains the first class counts.
    """
    table = np.concatenate((matrix[:CLASSES].T, matrix[:, :CLASSES]))
    out, into = matrix.sum(1)[:CLASSES], matrix.sum(0)[:CLASSES]
    start = np.flatnonzero(np.diff(row, prepend=-1))
    total = np.add.reduceat(np.where(code < ALL_CLASSES, n, 0), start)
    gain = np.add.reduceat(_xlogx(table[code] + n[:, None]) - _xlogx(table)[code], start)
    for side in (out, into):
        gain -= _xlogx(side + total[:, None]) - _xlogx(side)
    return gain.argmax(1), total


def _classes_by_context(state):
    """(word, length, n, c) of words with the list of their contexts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = state.value
        for batch in batches:
            lists = batch.column("contexts")
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            flat = lists.flatten()
            code, n = flat.field("code").to_numpy().astype(np.int64), flat.field("n").to_numpy()
            row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            length = code[ends - 1] // PAIRS
            c, total = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
            at = 0
            while at < len(ends):
                first = ends[at - 1] if at else 0
                to = max(int(np.searchsorted(ends, first + CONTEXTS, side="right")), at + 1)
                part = slice(first, ends[to - 1])
                c[at:to], total[at:to] = _joined_classes(matrix, *_sides(row[part] - at, code[part], n[part]))
                at = to
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), *(pa.array(x.astype(t)) for x, t in ((length, np.int32), (total, np.int64), (c, np.int32)))],
                names=["word", "length", "n", "c"],
            )

    return run


@dataclass
class BrownModel:
    """What every task needs to score a text, of a size that the parameters bound."""

    lookup: np.ndarray  # frequent words, sorted, the end among them
    counts: np.ndarray
    classes: np.ndarray  # of the words of ``lookup``
    unseen: np.ndarray  # class of a word that is not in the training texts, by its length
    emission: np.ndarray  # per class: log10 of the emission's denominator
    train_tokens: int
    base: float  # log10 of the base score's denominator
    transition: np.ndarray | None = None  # log10 P(class | class before)


def _known(tokens: Tokens, m) -> tuple[np.ndarray, np.ndarray]:
    """(count, class) of the tokens whose word every task has; class -1 of others."""
    at = _find(m.lookup, tokens.hashes)
    return np.where(at >= 0, m.counts[at], 0), np.where(at >= 0, m.classes[at], -1)


def _occurrences(model):
    """The tokens whose class is not at hand, and the class pairs of all others.

    A token: the key of its text, its place, word and context, that is (length, class
    before + 1, class after + 1), 0 where that neighbour's class is not at hand either.
    A class pair of training texts: its code as ``context``, and its count ``n``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**model.value)
        names = ["text_key", "place", "word", "context", "n"]
        total = np.zeros(PAIRS, dtype=np.int64)
        for part in slices(batches):
            tokens = Tokens.of(part.column("text"))
            _, c = _known(tokens, m)
            before = _before(tokens, c, START_CLASS)
            text_of = np.repeat(np.arange(len(tokens.first)), np.diff(np.append(tokens.first, len(c))))
            both = part.column("train").to_numpy(zero_copy_only=False)[text_of] & (c >= 0) & (before >= 0)
            total += np.bincount(before[both] * ALL_CLASSES + c[both], minlength=PAIRS)
            rare = np.flatnonzero(c < 0)
            text = text_of[rare]
            context = (tokens.length[rare] * (ALL_CLASSES + 1) + before[rare] + 1) * (ALL_CLASSES + 1) + c[rare + 1] + 1
            yield pa.RecordBatch.from_arrays(
                [part.column("text_key").take(pa.array(text)), pa.array((rare - tokens.first[text]).astype(np.int32)), pa.array(tokens.hashes[rare]),
                 pa.array(context.astype(np.int32)), pa.nulls(len(rare), pa.int64())],
                names=names,
            )
        pair = np.flatnonzero(total)
        none = [pa.nulls(len(pair), t) for t in (pa.int64(), pa.int32(), pa.int64())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(pair.astype(np.int32)), pa.array(total[pair])], names=names)

    return run


def _joined_pairs(unseen):
    """(text_key, known, seen, pairs) of texts with the list of such tokens.

    The pairs are those of classes of which one was not at hand: first codes of a
    token's class after the one before it, then, PAIRS higher, of the class after it
    where that is of another kind of token.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = unseen.value
        for batch in batches:
            lists = batch.column("tokens")
            sizes = pc.list_value_length(lists).to_numpy()
            flat = lists.flatten()
            place, context = (flat.field(x).to_numpy().astype(np.int64) for x in ("place", "context"))
            n, c = (pc.fill_null(flat.field(x), none).to_numpy().astype(np.int64) for x, none in (("n", 0), ("c", -1)))
            row = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((place, row))
            context, n, c = context[order], n[order], c[order]
            after, context = context % (ALL_CLASSES + 1) - 1, context // (ALL_CLASSES + 1)
            before, length = context % (ALL_CLASSES + 1) - 1, context // (ALL_CLASSES + 1)
            c = np.where(c < 0, by_length[length], c)
            before = np.where(before < 0, np.roll(c, 1), before)
            pairs = np.stack((before * ALL_CLASSES + c, np.where(after < 0, -1, PAIRS + c * ALL_CLASSES + after)), axis=1).ravel()
            there = pairs >= 0
            ends = np.cumsum(np.append(0, np.bincount(row, weights=1 + (after >= 0), minlength=len(sizes)))).astype(np.int32)
            first = np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [batch.column("text_key"), pa.array(np.add.reduceat((n > 0).astype(np.int64), first)), pa.array(np.add.reduceat(np.log10(n + ADD), first)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(pairs[there].astype(np.int32)))],
                names=["text_key", "known", "seen", "pairs"],
            )

    return run


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the class pairs of texts that come ``copies`` times."""
    total = np.zeros(PAIRS, dtype=np.int64)
    for batch in batches:
        lists = batch.column("pairs")
        copies = np.repeat(batch.column("copies").to_numpy(), pc.list_value_length(lists).to_numpy())
        np.add.at(total, lists.flatten().to_numpy() % PAIRS, copies)
    pair = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int32)), pa.array(total[pair])], names=["context", "n"])


def _moves(model):
    """(text_key, known, seen, moves): the score that the joined pairs of a text add."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**model.value)
        value = np.concatenate(((m.transition - m.emission).ravel(), m.transition.ravel()))
        for batch in batches:
            lists = batch.column("pairs")
            sizes = pc.list_value_length(lists).to_numpy()
            moves = np.add.reduceat(value[lists.flatten().to_numpy()], np.cumsum(sizes) - sizes)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("text_key", "known", "seen")), pa.array(moves)], names=["text_key", "known", "seen", "moves"])

    return run


def learn(training: DataFrame) -> tuple[BrownModel, DataFrame]:
    """The classes learned from ``training(text)``, and (word, length, n, c) of the words not clustered.

    The most frequent words are exchanged between the classes in rounds. Every other
    word then joins the class it gains most by, given all its contexts in the training
    texts; neighbours that are not clustered count there by their length. A word that
    is not in the training texts has the class which most such words of its length have.
    """
    spark = training.sparkSession
    counts = stored(
        training.mapInArrow(_word_counts, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")),
        "words",
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    end = counts.where(F.col("word") == int(_END)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    no_end = counts.where(F.col("word") != int(_END)).select("word", "n")
    top = commonest(no_end, LOOKUP).toArrow()
    if top.num_rows < CLUSTERED:  # few words, or more than LOOKUP of one frequency
        top = no_end.orderBy(F.desc("n"), "word").limit(CLUSTERED).toArrow()
    words, n = top.column("word").to_numpy(), top.column("n").to_numpy()
    ranked = np.lexsort((words, -n))[:CLUSTERED]
    by_word = np.argsort(words[ranked])
    clustered, times = words[ranked][by_word], n[ranked][by_word]
    pairs = stored(
        training.mapInArrow(_pair_counts(spark.sparkContext.broadcast(clustered)), "a bigint, b bigint, n bigint")
        .groupBy("a", "b").agg(F.sum("n").alias("n")),
        "pairs",
    )
    classes, matrix = exchange_classes(pairs, by_word % CLASSES)  # dealt out by rank

    beside = training.mapInArrow(_contexts(spark.sparkContext.broadcast((clustered, classes))), "word bigint, code int, n bigint")
    beside = beside.repartition("word").groupBy("word", "code").agg(F.sum("n").alias("n"))
    lists = beside.groupBy("word").agg(F.collect_list(F.struct("code", "n")).alias("contexts"))
    rest = stored(lists.mapInArrow(_classes_by_context(spark.sparkContext.broadcast(matrix)), "word bigint, length int, n bigint, c int"), "classes")

    sizes = rest.groupBy("length", "c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).toArrow()
    length, c, of_class, v = (sizes.column(x).to_numpy() for x in ("length", "c", "n", "v"))
    tokens, distinct, by_length = np.zeros(ALL_CLASSES), np.zeros(ALL_CLASSES), np.zeros((LENGTHS + 1, CLASSES))
    by_length[length, c] = v
    own = classes[: len(clustered)]
    np.add.at(tokens, np.concatenate((c, own, [END_CLASS])), np.concatenate((of_class, times, [end])))
    np.add.at(distinct, np.concatenate((c, own, [END_CLASS])), np.concatenate((v, np.ones(len(own)), [end > 0])))
    unseen = np.where(by_length.any(1), by_length.argmax(1), by_length.sum(0).argmax())

    more = commonest(rest.select("word", "n", "c"), LOOKUP).toArrow()
    lookup = np.concatenate((clustered, more.column("word").to_numpy(), [_END]))
    order = np.argsort(lookup)
    return BrownModel(
        lookup[order], np.concatenate((times, more.column("n").to_numpy(), [end]))[order],
        np.concatenate((own, more.column("c").to_numpy(), [END_CLASS]))[order].astype(np.int64), unseen,
        np.log10(tokens + ADD * (distinct + 1)), int(total["n"]), float(np.log10(total["n"] + ADD * (total["v"] + 1))),
    ), rest


def _transitions(*counted: DataFrame) -> np.ndarray:
    """log10 P(class | class before) from counts of class pairs."""
    matrix = np.zeros(PAIRS)
    for pairs in counted:
        found = pairs.groupBy("context").agg(F.sum("n").alias("n")).toArrow()
        matrix[found.column("context").to_numpy()] += found.column("n").to_numpy()
    matrix = matrix.reshape(ALL_CLASSES, ALL_CLASSES)
    unigram = (matrix.sum(0) + ADD) / (matrix.sum() + ADD * ALL_CLASSES)
    return np.log10((matrix + BACKOFF * unigram) / (matrix.sum(1, keepdims=True) + BACKOFF))


def _scores(model):
    """Scores of each text as far as they come from words whose counts are at hand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = SimpleNamespace(**model.value)
        for part in slices(batches):
            tokens = Tokens.of(part.column("text"))
            n, c = _known(tokens, m)
            here = c >= 0
            before = _before(tokens, c, START_CLASS)
            seen = np.where(here, np.log10(n + ADD), 0)
            score = seen + np.where(here & (before >= 0), m.transition[before, c], 0) - np.where(here, m.emission[c], 0)
            sums = [np.add.reduceat(v, tokens.first) for v in ((n > 0).astype(np.int64), seen - m.base, score)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(np.diff(np.append(tokens.first, len(c)))), *map(pa.array, sums)],
                names=["doc_id", "text_key", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def brown_scores(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) per row.

    Tokens are the words of the text lower-cased (A-Z), then one end. The model learns
    from rows whose crc32(key as text) mod 10 is not 0 and scores all rows. The
    base score is the add-0.1 unigram. The model: P(word | word before) =
    P(class | class before) * P(word | class); transitions are backed off to class
    frequencies, emissions are add-0.1 within the class, with one share for all
    unseen words. Exchange clustering puts the most frequent words in classes, every
    other training word joins one of them by its contexts, and words never seen in
    training go by their length (see ``learn``).

    Counts of words and of pairs are taken over all training texts. Every task is
    given counts and classes of the most frequent words; those of all other words are
    joined by word, to each of their tokens, and the class pairs these take part in are
    counted and scored then. Rows of equal text share one sum of them.

    Defined cases: NULL and empty texts are one end token. A NULL key counts as empty
    text, whose crc32 is 0: held out. Repeated rows learn and score as often as they
    come. Without training rows N and V are 0. Other columns are not looked at. Words
    are told apart by 64-bit hashes.
    """
    spark = documents.sparkSession
    fold = F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(FOLDS))
    training = documents.where(fold != 0).select(F.col(text).alias("text"))
    model, rest = learn(training)
    rows = documents.select(
        F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), (fold != 0).alias("train"), F.col(text).alias("text")
    )
    given = spark.sparkContext.broadcast(vars(model))
    tokens = rows.select("text_key", "train", "text").mapInArrow(_occurrences(given), "text_key bigint, place int, word bigint, context int, n bigint")
    tokens = stored(tokens, "tokens")
    each = tokens.where("n is null").select("text_key", "place", "word", "context").distinct()
    lists = each.join(rest.select("word", "n", "c"), "word", "left").groupBy("text_key").agg(
        F.collect_list(F.struct("place", "context", "n", "c")).alias("tokens")
    )
    schema = "text_key bigint, known bigint, seen double, pairs array<int>"
    joined = stored(lists.mapInArrow(_joined_pairs(spark.sparkContext.broadcast(model.unseen)), schema), "joined")
    copies = rows.where("train").groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    late = joined.select("text_key", "pairs").join(copies, "text_key").select("copies", "pairs").mapInArrow(_pair_sums, "context int, n bigint")
    model.transition = _transitions(tokens.where("n is not null").select("context", "n"), late)

    given = spark.sparkContext.broadcast(vars(model))
    schema = "doc_id bigint, text_key bigint, n_tokens bigint, n_known bigint, base_score double, score double"
    parts = rows.select("doc_id", "text_key", "text").mapInArrow(_scores(given), schema)
    added = joined.mapInArrow(_moves(given), "text_key bigint, known bigint, seen double, moves double")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(FOLDS)) == 0
    known, seen, moves = (F.coalesce(c, F.lit(0)) for c in ("known", "seen", "moves"))
    score = F.col("score") + seen + moves
    return parts.join(added, "text_key", "left").select(
        "doc_id", held.alias("held_out"), "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"), (F.col("base_score") + seen).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
