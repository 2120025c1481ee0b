"""Secrets in texts: fixed patterns and sliding-window entropy (operator 6)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns: kind, pattern, group whose length counts, least length. The last two
#: need no shorter matches, since whole runs of their characters are taken.
PATTERNS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"(AKIA[A-Z0-9]{16,})", 1, 20),
    ("hex", r"(?<![0-9a-f])([0-9a-f]{24,})", 1, 24),
)
#: A text without any of these, lower-cased, has no match of ``assign``.
ASSIGN_PARTS = ("passw", "secret", "token", "api")
WINDOW = 20
#: Share of random windows of a class that its entropy threshold misses at most.
MISS = 0.05
_LOWER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
#: Character classes of candidate strings, each within the next but for upper case: kind,
#: characters, how many a random string draws from, and the class in a pattern.
CLASSES = (
    ("entropy_hex", _DIGITS + "abcdefABCDEF", 16, "0-9A-Fa-f"),
    ("entropy_lower", _DIGITS + _LOWER, 36, "a-z0-9"),
    ("entropy_upper", _DIGITS + _LOWER.upper(), 36, "A-Z0-9"),
    ("entropy_base62", _DIGITS + _LOWER + _LOWER.upper(), 62, "A-Za-z0-9"),
    ("entropy_base64", _DIGITS + _LOWER + _LOWER.upper() + "+/_=-", 64, "A-Za-z0-9+/_=-"),
)
#: Candidates that are no secrets: without a letter, UUIDs, and runs of the alphabet or of digits.
ALLOWED = (
    r"^[0-9+/_=-]*$",
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)abcdefghij|0123456789",
)
#: Neither are names: these parts of one, and four digits at most besides.
NAME_PARTS = r"[A-Z]?[a-z]{3,}|[A-Z]{3,}|[+/_=-]+"
NAME_REST = r"^[0-9]{0,4}$"
#: c * log2(c) of the counts a window can have, in millionths: sums are exact.
_TERMS = [round(1e6 * c * math.log2(c)) if c else 0 for c in range(WINDOW + 1)]
#: Counts are at most twenty, five bits each, so twelve of them go into one number.
_BITS, _PACKED = 5, 12
#: Matches are numbered in groups of so many, so that lists are not copied per match.
_GROUP = 256
_SPAN = "struct<start: int, rank: int, stop: int, kind: string>"


def _partitions(total: int, largest: int):
    if total == 0:
        yield ()
    for part in range(min(total, largest), 0, -1):
        for rest in _partitions(total - part, part):
            yield (part, *rest)


def most_repetition(characters: int, miss: float = MISS) -> int:
    """The sum of c * log2(c), in millionths, that a random window exceeds that rarely.

    Exact: each way to have counts (a partition of the window) has its probability
    when every character is drawn alike.
    """
    chance: dict[int, float] = {}
    for counts in _partitions(WINDOW, WINDOW):
        if len(counts) <= characters:
            ways = math.perm(characters, len(counts)) * math.factorial(WINDOW)
            for c in counts:
                ways //= math.factorial(c)
            for c in set(counts):
                ways //= math.factorial(counts.count(c))
            total = sum(_TERMS[c] for c in counts)
            chance[total] = chance.get(total, 0.0) + ways / characters**WINDOW
    left = 1.0
    for total in sorted(chance):
        left -= chance[total]
        if left <= miss:
            return total
    return max(chance)


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(text: Column, pattern: str, group: int) -> Column:
    """(gap, whole, found) of all leftmost matches, and what follows the last as a gap.

    ``split`` gives what lies between the matches.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("whole"), found.alias("found"))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """(start, stop, found) of all leftmost matches, in code points.

    Places are running sums over groups of matches, then within each.
    """
    span = "struct<start: int, stop: int, found: string>"

    def step(state: Column, part: Column) -> Column:
        begin = state["at"] + F.char_length(part["gap"])
        end = begin + F.char_length(part["whole"])
        one = F.struct(begin.alias("start"), end.alias("stop"), part["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    def groups(parts: Column) -> Column:
        def numbered(state: Column, first: Column) -> Column:
            start = F.struct(state["at"].alias("at"), F.array().cast(f"array<{span}>").alias("out"))
            return _once(
                F.aggregate(F.slice(parts, first, _GROUP), start, step),
                lambda g: F.struct(g["at"].alias("at"), F.concat(state["out"], F.array(g["out"])).alias("out")),
            )

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{span}>>").alias("out"))
        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(parts), F.lit(1)), F.lit(_GROUP)), start, numbered, lambda s: F.flatten(s["out"]))

    return F.filter(_once(_parts(text, pattern, group), groups), lambda m: m["found"].isNotNull())


def _blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """The text with blanks in place of the matches that are long enough."""
    def piece(p: Column) -> Column:
        kept = F.when(F.char_length(p["found"]) >= least, F.repeat(F.lit(" "), F.char_length(p["whole"]))).otherwise(F.coalesce(p["whole"], F.lit("")))
        return F.concat(p["gap"], kept)

    return F.array_join(F.transform(_parts(text, pattern, group), piece), "")


def _base_spans(text: Column, rank: int) -> Column:
    kind, pattern, group, least = PATTERNS[rank]
    long_enough = F.filter(_matches(text, pattern, group), lambda m: F.char_length(m["found"]) >= least)
    spans = F.transform(
        long_enough, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["stop"].alias("stop"), F.lit(kind).alias("kind"))
    )
    return F.when(_may_match(text, kind), spans).otherwise(_none())


def _may_match(text: Column, kind: str) -> Column:
    """A quick look that is true for every text with a match that is long enough."""
    if kind == "assign":
        low = F.lower(text)
        return reduce(Column.__or__, [low.contains(part) for part in ASSIGN_PARTS])
    if kind == "access":
        return text.contains("AKIA")
    return text.rlike(r"[0-9a-f]{24}")


def _high_entropy(candidate: Column, number: int) -> Column:
    """(start, stop) of the stretches whose windows of twenty have enough entropy.

    The window moves a character at a time and the state keeps the count of every
    character of the class, five bits each. The character that leaves and the one that
    comes change one count each, so the sum of c * log2(c) changes by two terms; the
    entropy is log2(20) less a twentieth of that sum. Characters are looked up in a
    list that is made once, so the work grows with the length.
    """
    _, alphabet, drawn, _ = CLASSES[number]
    most = most_repetition(drawn)
    terms = F.array(*[F.lit(t) for t in _TERMS])
    words = range(-(-len(alphabet) // _PACKED))

    def changed(counts: list[Column], code: Column, by: int) -> tuple[list[Column], Column]:
        """The counts with that of one character changed, and what it was."""
        word, shift = F.floor(code / _PACKED), (code % _PACKED) * _BITS
        one = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)
        of = reduce(lambda rest, w: F.when(word == w, counts[w]).otherwise(rest), words, F.lit(0).cast("bigint"))
        before = F.call_function("shiftright", of, shift).bitwiseAND((1 << _BITS) - 1).cast("int")
        return [F.when(word == w, counts[w] + by * one).otherwise(counts[w]) for w in words], before

    def scanned(codes: Column) -> Column:
        def leave(state: Column, i: Column) -> Column:
            counts = [state[f"c{w}"] for w in words]
            left, k = changed(counts, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1))), -1)
            full = i > WINDOW
            drop = F.when(full, F.element_at(terms, k) - F.element_at(terms, k + 1)).otherwise(0)
            kept = [F.when(full, a).otherwise(b).alias(f"c{w}") for w, a, b in zip(words, left, counts, strict=True)]
            return F.struct((state["total"] + F.when(full, drop).otherwise(0)).cast("int").alias("total"), *kept)

        def come(state: Column, moved: Column, i: Column) -> Column:
            counts, m = changed([moved[f"c{w}"] for w in words], F.element_at(codes, i), 1)
            total = moved["total"] + F.element_at(terms, m + 2) - F.element_at(terms, m + 1)
            hit = (i >= WINDOW) & (total <= most)
            joins = hit & (state["stop"] >= i - WINDOW)
            opens = hit & ~joins
            done = F.struct(state["start"].alias("start"), state["stop"].alias("stop"))
            closed = F.when(opens & (state["stop"] > 0), F.concat(state["out"], F.array(done))).otherwise(state["out"])
            return F.struct(
                total.cast("int").alias("total"), F.when(opens, i - WINDOW).otherwise(state["start"]).cast("int").alias("start"),
                F.when(hit, i).otherwise(state["stop"]).cast("int").alias("stop"), closed.alias("out"),
                *[c.alias(f"c{w}") for w, c in zip(words, counts, strict=True)],
            )

        def step(state: Column, i: Column) -> Column:
            return _once(leave(state, i), lambda moved: come(state, moved, i))

        begin = F.struct(
            F.lit(0).alias("total"), F.lit(0).alias("start"), F.lit(0).alias("stop"), F.array().cast("array<struct<start: int, stop: int>>").alias("out"),
            *[F.lit(0).cast("bigint").alias(f"c{w}") for w in words],
        )
        last = lambda s: F.when(
            s["stop"] > 0, F.concat(s["out"], F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
        ).otherwise(s["out"])
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), begin, step, last)

    return _once(F.transform(F.split(candidate, ""), lambda c: F.instr(F.lit(alphabet), c) - 1), scanned)


def _pattern(number: int) -> str:
    characters = CLASSES[number][3]
    return f"(?<![{characters}])([{characters}]{{{WINDOW},}})"


def _entropy_spans(text: Column, number: int) -> Column:
    kind = CLASSES[number][0]
    rank = len(PATTERNS) + number
    suspects = F.filter(_matches(text, _pattern(number), 1), lambda m: ~_allowed(m["found"]))
    spans = F.flatten(F.transform(suspects, lambda m: F.transform(
        _high_entropy(m["found"], number),
        lambda s: F.struct((m["start"] + s["start"]).alias("start"), F.lit(rank).alias("rank"), (m["start"] + s["stop"]).alias("stop"), F.lit(kind).alias("kind")),
    )))
    return F.when(text.rlike(_pattern(number)), spans).otherwise(_none())


def _allowed(candidate: Column) -> Column:
    name = F.regexp_replace(candidate, NAME_PARTS, "").rlike(NAME_REST)
    return reduce(Column.__or__, [candidate.rlike(pattern) for pattern in ALLOWED], name)


def secret_spans(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans) per row: arrays of (start, rank, stop, kind), in order.

    ``base`` has the matches of the fixed patterns that are long enough, a kind at a
    time: leftmost, not overlapping, whole matches. ``spans`` adds stretches of
    candidate strings whose every window of twenty has high Shannon entropy, unless
    the candidate is on the allow-list. Candidates are runs of one character class,
    twenty or more, in what the base spans leave; a threshold per class misses a
    twentieth of its random windows at most. Where stretches of several classes
    overlap, the one that starts first has the place, in order of the classes where
    they start together, and another keeps what lies beyond it. Places are code points,
    stop exclusive; order is by start, then kind as listed, then stop.

    Defined cases: NULL and empty texts have no spans. Texts and candidates of any
    length are scanned whole, in time that grows with the length. Repeated rows and
    NULL keys are kept. Other columns are not looked at.
    """
    rows = documents.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = rows.select("doc_id", "text", F.sort_array(F.concat(*[_base_spans(F.col("text"), i) for i in range(len(PATTERNS))])).alias("base"))
    for kind, pattern, group, least in PATTERNS:
        there = F.array_contains(F.transform("base", lambda s: s["kind"]), kind)
        found = found.withColumn("text", F.when(there, _blanked(F.col("text"), pattern, group, least)).otherwise(F.col("text")))
    found = found.select("doc_id", "base", *[_entropy_spans(F.col("text"), i).alias(kind) for i, (kind, *_) in enumerate(CLASSES)])
    return found.select("doc_id", "base", F.sort_array(F.concat("base", _apart([kind for kind, *_ in CLASSES]))).alias("spans"))


def _apart(kinds: list[str]) -> Column:
    """The spans of all kinds in order, each without what lies before the furthest stop so far."""
    every = F.sort_array(F.concat(*kinds))

    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(s["start"], state["at"])
        rest = F.struct(begin.alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"), s["kind"].alias("kind"))
        return F.struct(
            F.greatest(state["at"], s["stop"]).alias("at"),
            F.when(s["stop"] > begin, F.concat(state["out"], F.array(rest))).otherwise(state["out"]).alias("out"),
        )

    return F.aggregate(every, F.struct(F.lit(0).alias("at"), _none().alias("out")), step, lambda s: s["out"])


def span_names(spans: Column) -> Column:
    """kind:start:stop of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
