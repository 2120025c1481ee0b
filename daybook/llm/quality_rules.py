"""Document quality by weak supervision of rules (operator 1)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrowtext import SPACE, buffers, grams, slices, spans, word_hashes

REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
ROUNDS = 40
KEEP_FROM = 0.5

FEATURES = (
    "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_adjacent n_distinct n_upper n_letters n_exclaim n_marked"
).split()


def _bytes_of(chars: str) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    mask[np.frombuffer(chars.encode(), dtype=np.uint8)] = True
    return mask


_SYMBOL = _bytes_of(SYMBOLS)
_UPPER = _bytes_of("".join(map(chr, range(65, 91))))
_LETTER = _UPPER | _bytes_of("".join(map(chr, range(97, 123)))) | (np.arange(256) >= 0xC0)  # any beyond ASCII counts as one
_EXCLAIM = _bytes_of("!")
_CHAR = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often the mask is true in each row."""
    rows = len(offsets) - 1
    if rows == 0 or len(mask) == 0:
        return np.zeros(rows, dtype=np.int64)
    padded = np.append(mask, False)
    found = np.add.reduceat(padded, offsets[:-1], dtype=np.int64)
    return np.where(offsets[1:] > offsets[:-1], found, 0)


def _repeated(words: np.ndarray) -> int:
    """Words inside windows of eight words that occur twice or more."""
    if len(words) <= REPEAT_WINDOW:
        return 0
    windows = grams(words, REPEAT_WINDOW)
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + REPEAT_WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def _measure(column: pa.Array) -> list[np.ndarray]:
    """The features of each text, in the order of FEATURES."""
    data, offsets = buffers(column)
    starts, ends = spans(data, offsets)
    words = word_hashes(data, starts, ends)
    at = np.searchsorted(starts, offsets)
    marked = np.add.reduceat(_SYMBOL[data], starts, dtype=np.int64) > 0 if len(starts) else np.zeros(0, dtype=bool)
    n = len(column)
    lines, dup_lines, repeat, adjacent, distinct = (np.zeros(n, dtype=np.int64) for _ in range(5))
    for i, text in enumerate(column.to_pylist()):
        own = words[at[i] : at[i + 1]]
        if len(own) == 0:
            continue
        with_word = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
        lines[i], dup_lines[i] = len(with_word), len(with_word) - len(set(with_word))
        repeat[i] = _repeated(own)
        adjacent[i] = np.count_nonzero(own[1:] == own[:-1])
        distinct[i] = len(np.unique(own))
    return [
        np.diff(at), _per_row(_CHAR[data] & ~SPACE[data], offsets), _per_row(_SYMBOL[data], offsets), lines, dup_lines,
        repeat, adjacent, distinct, _per_row(_UPPER[data], offsets), _per_row(_LETTER[data], offsets), _per_row(_EXCLAIM[data], offsets),
        _per_row(marked, at),
    ]


def measured(documents: DataFrame, carry: Sequence[str], text: str, into: str) -> DataFrame:
    """The ``carry`` columns and a struct ``into`` of the features.

    The text goes to the workers once, also where it is carried.
    """
    carried = text in carry and documents.schema[text].dataType.simpleString() == "string"
    at = list(carry).index(text) if carried else len(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, at):
            values = _measure(part.column(at))
            features = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in values], names=FEATURES)
            yield pa.RecordBatch.from_arrays([*part.columns[: len(carry)], features], names=[*part.schema.names[: len(carry)], into])

    measure = [] if carried else [F.col(f"`{text}`").cast("string").alias(into)]
    inner = documents.select(*[F.col(f"`{c}`") for c in carry], *measure)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[: len(carry)])
    fields = ", ".join(f"{f}: bigint" for f in FEATURES)
    return inner.mapInArrow(run, f"{kept}{', ' if kept else ''}`{into}` struct<{fields}>")


@dataclass(frozen=True)
class Rule:
    """Votes good (1), bad (-1) or abstains (0) on a share of two features."""

    name: str
    part: str
    whole: str
    good: tuple[float, float]  # votes good inside
    fair: tuple[float, float]  # abstains inside, votes bad outside


#: The share a rule looks at, where it votes good, where it abstains.
RULES = (
    Rule("symbols", "n_symbols", "n_words", (0, 0.02), (0, 0.1)),
    Rule("exclamations", "n_exclaim", "n_words", (0, 0.05), (0, 0.15)),
    Rule("capitals", "n_upper", "n_letters", (0, 0.15), (0, 0.35)),
    Rule("repeats", "n_repeat_words", "n_words", (0, 0.1), (0, 0.3)),
    Rule("stutter", "n_adjacent", "n_words", (0, 0.05), (0, 0.15)),
    Rule("variety", "n_distinct", "n_words", (0.3, 1), (0.1, 1)),
    Rule("duplicate lines", "n_dup_lines", "n_lines", (0, 0.1), (0, 0.3)),
    Rule("word length", "word_chars", "n_words", (3, 9), (2, 14)),
    Rule("letters", "n_letters", "word_chars", (0.9, 1), (0.8, 1)),
    Rule("marked words", "n_marked", "n_words", (0, 0.02), (0, 0.1)),
)


def _by_vote(rule: Rule, features: str, bad: float, abstains: float, good: float) -> Column:
    """The value that goes with the rule's vote."""
    part, whole = F.col(f"`{features}`.{rule.part}"), F.col(f"`{features}`.{rule.whole}")
    share = part.cast("double") / whole.cast("double")
    return F.when(whole == 0, abstains).when(share.between(*rule.good), good).when(share.between(*rule.fair), abstains).otherwise(bad)


def _pattern(features: str) -> Column:
    """All votes as one number in base three, the first rule in the last digit."""
    digits = [_by_vote(rule, features, 0, 3**i, 2 * 3**i) for i, rule in enumerate(RULES)]
    return reduce(Column.__add__, digits)


@dataclass(frozen=True)
class VoteModel:
    """Log odds of good: a bias, and one weight per rule and vote (-1, 0, 1)."""

    bias: float
    weights: tuple[tuple[float, float, float], ...]

    def probability(self, features: str) -> Column:
        votes = [_by_vote(rule, features, *weights) for rule, weights in zip(RULES, self.weights, strict=True)]
        return 1 / (1 + F.exp(-reduce(Column.__add__, votes, F.lit(self.bias))))


def fit(votes: np.ndarray, count: np.ndarray, rounds: int = ROUNDS) -> VoteModel:
    """Expectation-maximisation over vote patterns and how many rows have each.

    Given its class (good or bad) a row's votes are taken as independent. The start
    is the share of good votes; two pseudo-rows per rule and class, voting by the
    rule's meaning, keep every estimate off zero and the classes from swapping.
    """
    rules = votes.shape[1]
    good = (votes == 1).sum(1)
    bad = (votes == -1).sum(1)
    q = (good + 1.0) / (good + bad + 2.0)
    q = np.where(bad >= 2, np.minimum(q, 0.3), q)
    prior, tables = 0.5, np.zeros((rules, 2, 3))
    for _ in range(rounds):
        weight = np.stack([count * (1 - q), count * q])
        total = weight.sum(1)
        prior = (total[1] + 1.0) / (total.sum() + 2.0)
        for j in range(rules):
            for c in (0, 1):
                for v in (-1, 0, 1):
                    pseudo = 1.0 if v == 0 else (1.5 if v == 2 * c - 1 else 0.5)
                    tables[j, c, v + 1] = (weight[c][votes[:, j] == v].sum() + pseudo) / (total[c] + 3.0)
        odds = math.log(prior / (1 - prior)) + sum(
            np.log(tables[j, 1, votes[:, j] + 1] / tables[j, 0, votes[:, j] + 1]) for j in range(rules)
        )
        q = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    ratio = np.log(tables[:, 1, :] / tables[:, 0, :])
    return VoteModel(math.log(prior / (1 - prior)), tuple(tuple(float(x) for x in row) for row in ratio))


def learned(patterns: DataFrame) -> VoteModel:
    """The model of all rows of ``patterns(pattern)``.

    Rows are counted by pattern first; the driver gets at most 3^rules counts.
    """
    counted = patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in counted], dtype=np.int64)
    count = np.array([r["n"] for r in counted], dtype=np.float64)
    votes = np.stack([(codes // 3**i) % 3 - 1 for i in range(len(RULES))], axis=1) if len(codes) else np.zeros((0, len(RULES)), int)
    return fit(votes, count)


def _fresh(columns: Sequence[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def quality_rules(documents: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), into: str = "quality") -> DataFrame:
    """The ``carry`` columns and a struct ``into``: features, ``base_failed``,
    ``probability`` (posterior that the row is good) and ``kept``, per row.

    Base: under 20 words, or more than 30 % of the words inside eight-word windows
    that occur twice or more in the text. ``kept`` is false for those, else true if
    the posterior is 0.5 or more. The posterior comes from rules that vote or
    abstain, whose accuracies are estimated on all rows of ``documents``
    (see ``fit``); no rule is a veto.

    Texts are measured whole, twice: once for the estimates, once for the verdicts.

    Defined cases: a NULL text counts as empty: no words, so it fails. NULLs in
    carried columns stay. Repeated rows count as often as they come. An empty table
    gives no rows. A carried column may have any name but ``into``; where it has that,
    the struct's name gets underscores appended.
    """
    into = _fresh(carry, into)
    rows = measured(documents, carry, text, into)
    model = learned(measured(documents, (), text, into).select(_pattern(into).alias("pattern")))
    words, repeat = F.col(f"`{into}`.n_words"), F.col(f"`{into}`.n_repeat_words")
    failed = (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * words)
    probability = model.probability(into)
    return rows.select(
        *[F.col(f"`{c}`") for c in carry],
        F.struct(
            *[F.col(f"`{into}`.{f}").alias(f) for f in FEATURES],
            failed.alias("base_failed"),
            probability.alias("probability"),
            (~failed & (probability >= KEEP_FROM)).alias("kept"),
        ).alias(into),
    )


def keep_good(documents: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``documents``, all columns, that ``quality_rules`` keeps."""
    into = _fresh(documents.columns, "quality")
    judged = quality_rules(documents, text, documents.columns, into)
    return judged.where(F.col(f"`{into}`.kept")).select(*[F.col(f"`{c}`") for c in documents.columns])
