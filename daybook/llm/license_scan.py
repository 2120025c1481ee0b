"""Licence notices by a trained paragraph classifier (operator 8)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructType

from daybook.llm.arrowtext import buffers, slices, spans
from daybook.llm.tables import lower_ascii, stored

#: Notices of each family.
TEMPLATES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
        "the License. You may obtain a copy of the License at",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    "MPL-2.0": (
        "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright (c) the authors. All rights reserved.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
NONE, UNKNOWN = "none", "unknown"
#: A notice has at least one of these; paragraphs without are no candidates.
CUES = (
    r"(?i)licen[cs]|copyright|spdx|all rights reserved|permission is hereby|redistribut|free software|public domain|"
    r"creative commons|\bCC[ -]BY|\bGPL|\bBSD\b"
)
#: In lower case, what a text has somewhere if one of its paragraphs has a cue.
CUE_PARTS = (
    "licen", "copyright", "spdx", "all rights reserved", "permission is hereby", "redistribut", "free software", "public domain",
    "creative commons", "cc by", "cc-by", "gpl", "bsd",
)
FEATURES = 1 << 14
#: What the corpus's paragraphs weigh in training, all together, at most: each weighs 1
#: up to so many. The templates keep their share of the loss in a large corpus.
NEGATIVE_WEIGHT = 2000.0
#: Of the calibration half so many may pass for a family.
FALSE_SHARE = 0.001
LEVELS = 10_000
CONFIRM_FROM = 0.5
PIECE, STRIDE = 64, 32
#: L2 penalty of the regression, on standardised features.
PENALTY = 0.002
#: Passes over the training rows at most, and the relative gain of a pass that ends them.
PASSES, TOLERANCE = 60, 1e-6
#: Rows of other text on which the driver finds the point that the passes start from,
#: and the way from one pass to the next.
START_ROWS = 1 << 13
#: Points that a step is mixed from.
DEPTH = 6
#: Tasks of a pass at most whose gradients (1.2 MB each) go to the driver as they are.
TASKS = 64
AROUND, AROUND_WORDS = 8, 24

_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[list(b".0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
_FOLDED = np.where(_SEPARATOR, 0x20, np.arange(256)).astype(np.uint8)
_FOLDED[65:91] += 32


def paragraph_words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), r"[^a-z0-9.]+"), lambda w: w != "")


def word_pairs(words: Column) -> Column:
    n = F.size(words)
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.concat_ws(" ", F.element_at(words, i), F.element_at(words, i + 1)))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))


def paragraphs(documents: DataFrame, key: str, text: str, *others: str) -> DataFrame:
    """(doc_id, other columns, paragraph, content) of every line; NULL texts have none."""
    return documents.select(F.col(key).alias("doc_id"), *others, F.posexplode(F.split(F.col(text), "\n")).alias("paragraph", "content"))


def _may_have_cue(text: Column) -> Column:
    """False only if the pattern CUES is found nowhere in a text: a plain search, much cheaper than the pattern.

    The text is lowered once, as the only element that ``exists`` looks at.
    """
    found = F.exists(F.array(F.lower(text)), lambda t: reduce(Column.__or__, [t.contains(part) for part in CUE_PARTS]))
    return F.coalesce(found, F.lit(False))


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, notice) for family, notices in TEMPLATES.items() for notice in notices]
    frame = spark.createDataFrame(rows, "family string, notice string")
    return frame.select("family", paragraph_words(F.col("notice")).alias("words"))


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint32(by)) | (x >> np.uint32(32 - by))


def _buckets(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The feature of each span of bytes: Murmur3 as Spark ML's HashingTF takes it of terms."""
    wide = np.append(data, np.zeros(4, dtype=np.uint8)).astype(np.uint32)
    four = wide[:-3] | wide[1:-2] << np.uint32(8) | wide[2:-1] << np.uint32(16) | wide[3:] << np.uint32(24)

    def mixed(k: np.ndarray) -> np.ndarray:
        return _rotated(k * np.uint32(0xCC9E2D51), 15) * np.uint32(0x1B873593)

    h, blocks = np.full(len(starts), 42, dtype=np.uint32), sizes >> 2
    live, done = np.flatnonzero(blocks), 0
    while len(live):
        h[live] = _rotated(h[live] ^ mixed(four[starts[live] + 4 * done]), 13) * np.uint32(5) + np.uint32(0xE6546B64)
        done += 1
        live = live[blocks[live] > done]
    tail = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], dtype=np.uint32)[sizes & 3]
    h ^= mixed(four[starts + 4 * blocks] & tail) ^ sizes.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return ((h ^ h >> np.uint32(16)) % np.uint32(FEATURES)).astype(np.int64)


@dataclass
class _Pieces:
    """Pieces of the rows of a column: words ``first`` to ``first + words`` of those whose bytes
    are in ``plain``, folded, one space after each word of a row."""

    plain: np.ndarray
    starts: np.ndarray  # of all words
    sizes: np.ndarray
    row: np.ndarray  # of each piece
    number: np.ndarray
    first: np.ndarray
    words: np.ndarray

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(how many features of each piece, the pieces' features), distinct in a piece."""
        single = _buckets(self.plain, self.starts, self.sizes)
        pair = _buckets(self.plain, self.starts[:-1], self.starts[1:] + self.sizes[1:] - self.starts[:-1])
        of = np.repeat(np.arange(len(self.row)), self.words)
        word = np.arange(len(of)) + np.repeat(self.first - (np.cumsum(self.words) - self.words), self.words)
        inner = np.flatnonzero(of[1:] == of[:-1])
        found = np.sort(np.concatenate((of * FEATURES + single[word], of[inner] * FEATURES + pair[word[inner]])))
        found = found[np.diff(found, prepend=-1) > 0]
        return np.bincount(found // FEATURES, minlength=len(self.row)), found % FEATURES

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words of these pieces, each with a space between them; all have words."""
        last = self.first[which] + self.words[which] - 1
        spans = zip(self.starts[self.first[which]], self.starts[last] + self.sizes[last], strict=True)
        return pa.array([self.plain[start:end].tobytes().decode("ascii") for start, end in spans], pa.string())


def _pieces_of(column: pa.Array, cut: bool) -> _Pieces:
    """Rows without words have no piece; if not ``cut``, every row is one piece."""
    data, offsets = buffers(column)
    starts, ends = spans(data, offsets, _SEPARATOR)
    at = np.searchsorted(starts, offsets)
    sizes = ends - starts
    kept = ~_SEPARATOR[data]
    kept[ends[ends < len(data)]] = True  # one separator after a word
    starts = (np.cumsum(kept) - kept)[starts]
    plain = _FOLDED[data[kept]]
    n = np.diff(at)
    pieces = np.where(n <= PIECE, np.minimum(n, 1), (n - STRIDE - 1) // STRIDE + 1) if cut else np.ones(len(n), dtype=np.int64)
    row = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = at[row] + STRIDE * number
    return _Pieces(plain, starts, sizes, row, number, first, np.minimum(at[row + 1] - first, PIECE) if cut else n)


def _grams(column: pa.Array, cut: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, number in its row, how many features) of each piece, and the pieces' features.

    Features are distinct in a piece: its words and pairs of neighbouring words, hashed.
    """
    pieces = _pieces_of(column, cut)
    return pieces.row, pieces.number, *pieces.grams()


def _packed(sizes: np.ndarray, features: np.ndarray) -> pa.Array:
    """The features of each piece as bytes, two for each."""
    offsets = np.append(0, 2 * np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(features.astype("<u2"))])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(column)
    return np.diff(offsets) // 2, np.ascontiguousarray(data).view("<u2").astype(np.intp)


def _margins(weights: np.ndarray, intercepts: np.ndarray, sizes: np.ndarray, features: np.ndarray) -> np.ndarray:
    """(class, piece): sums of the weights of a piece's features."""
    first, out = np.cumsum(sizes) - sizes, np.empty((len(weights), len(sizes)))
    for of_class, sums in zip(weights, out, strict=True):
        sums[:] = np.add.reduceat(np.append(of_class.take(features), 0.0), first) if len(sizes) else 0.0
    out[:, sizes == 0] = 0.0
    return out + intercepts[:, None]


def _shares(margins: np.ndarray) -> np.ndarray:
    shares = np.exp(margins - margins.max(0))
    return shares / shares.sum(0)


def _loss(weights: np.ndarray, intercepts: np.ndarray, rows: pa.RecordBatch) -> np.ndarray:
    """Log loss of ``rows(label, weight, grams)`` and its slopes by weights and intercepts, in one vector."""
    label, weight = rows.column("label").to_numpy().astype(np.intp), rows.column("weight").to_numpy()
    sizes, features = _unpacked(rows.column("grams"))
    margins = _margins(weights, intercepts, sizes, features)
    margins -= margins.max(0)
    own = margins[label, np.arange(len(label))]
    shares = np.exp(margins)
    total = shares.sum(0)
    loss = weight @ (np.log(total) - own)
    shares /= total
    shares[label, np.arange(len(label))] -= 1
    shares *= weight
    slopes = np.empty_like(weights)
    for k in range(1, len(weights)):
        slopes[k] = np.bincount(features, np.repeat(shares[k], sizes), minlength=FEATURES)
    slopes[0] = -slopes[1:].sum(0)  # the residuals of a row add up to nothing
    return np.concatenate(([loss], slopes.ravel(), shares.sum(1)))


def _moments(rows: pa.RecordBatch) -> np.ndarray:
    """Weight of the rows that have each feature, of all rows, and its squares."""
    weight = rows.column("weight").to_numpy()
    sizes, features = _unpacked(rows.column("grams"))
    return np.append(np.bincount(features, np.repeat(weight, sizes), minlength=FEATURES), (weight.sum(), weight @ weight))


def _sums(rows: DataFrame, vector: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of a vector over all rows: the driver gets one per task, TASKS at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in slices(batches):
            found = vector(part)
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                found = np.frombuffer(value.as_buffer())
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["total"])

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.coalesce(tasks).mapInArrow(run, "total binary")
    if tasks > TASKS:
        parts = parts.repartition(TASKS).mapInArrow(added, "total binary")
    return sum(np.frombuffer(value.as_buffer()) for value in parts.toArrow().column("total"))


def _least(slope: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, passes: int, tolerance: float) -> np.ndarray:
    """Where a smooth convex function is least, by L-BFGS; ``slope`` gives value and gradient."""
    value, gradient = slope(x)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used, small = 1, 0
    while used < passes and small < 2:
        direction, memory = gradient.copy(), []
        for s, y in reversed(steps):
            a = (s @ direction) / (s @ y)
            direction -= a * y
            memory.append(a)
        if steps:
            s, y = steps[-1]
            direction *= (s @ y) / (y @ y)
        for (s, y), a in zip(steps, reversed(memory), strict=True):
            direction += s * (a - (y @ direction) / (s @ y))
        step = 1.0 if steps else 1.0 / max(1.0, float(np.sqrt(gradient @ gradient)))
        fall = gradient @ direction
        if fall <= 0:
            break
        while used < passes:
            after = x - step * direction
            lower, turned = slope(after)
            used += 1
            if lower <= value - 1e-4 * step * fall:
                break
            step /= 2
        else:
            break
        if (after - x) @ (turned - gradient) > 0:
            steps = [*steps[-9:], (after - x, turned - gradient)]
        small = small + 1 if value - lower <= tolerance * abs(lower) else 0
        x, value, gradient = after, lower, turned
    return x


def _settled(everywhere, near, x: np.ndarray, passes: int, tolerance: float) -> np.ndarray:
    """Where ``everywhere`` is least, in few calls of it; ``near`` is cheap and curved alike.

    Each round takes value and gradient of the whole at x and finds where ``near``, tilted
    to have that gradient at x, is least. Both agree only where the whole is least, as
    nothing moves there. Moves of earlier rounds are mixed in (Anderson). It ends when a
    move promises a gain under a fiftieth of the tolerance; where rounds stop to gain,
    L-BFGS goes on from the best point with the passes that are left.
    """
    points: list[np.ndarray] = []
    moves: list[np.ndarray] = []
    least, best, used, worse = np.inf, x, 0, 0
    while used < passes and worse < 3:
        value, gradient = everywhere(x)
        used += 1
        worse = 0 if value < least else worse + 1
        if value < least:
            least, best = value, x
        tilt = gradient - near(x)[1]

        def tilted(y: np.ndarray, tilt: np.ndarray = tilt) -> tuple[float, np.ndarray]:
            found, slope = near(y)
            return found + tilt @ y, slope + tilt

        move = _least(tilted, x, PASSES, TOLERANCE / 1000) - x
        if worse == 0 and -(gradient @ move) / 2 <= tolerance / 50 * abs(value):
            return x
        points, moves = [*points[-DEPTH:], x], [*moves[-DEPTH:], move]
        x = x + move
        if len(points) > 1:
            turns = np.array([move - m for m in moves[:-1]])
            steps = np.array([points[-1] - p for p in points[:-1]])
            x = x - np.linalg.lstsq(turns.T, move, rcond=1e-6)[0] @ (steps + turns)
    return _least(everywhere, best, passes - used, tolerance) if used < passes else best


@dataclass
class LogisticRegression:
    """Multinomial regression with the objective of Spark ML's: mean loss by weight, and
    an L2 penalty on weights of standardised features.

    The features of a row are two bytes each and every pass reads the stored rows again,
    so no row is held in memory or written in a wider form between passes. Every pass
    takes all rows; between two of them the driver moves by a small part of the rows.
    """

    classes: int

    def fit(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """(weights by class and feature, intercepts) from ``rows(label, weight, grams)``."""
        spark = rows.sparkSession
        moments = _sums(rows, _moments)
        have, (total, squares) = moments[:FEATURES], moments[FEATURES:]
        mean = have / total
        spread = np.sqrt(np.maximum(have * (1 - mean) / max(total - squares / total, 1e-12), 0))
        scale = np.divide(1, spread, out=np.zeros(FEATURES), where=spread > 0)
        inner = self.classes * FEATURES

        def parameters(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            weights = x[:inner].reshape(self.classes, FEATURES) * scale
            return weights, x[inner:] - weights @ mean

        def objective(losses: Callable[[np.ndarray, np.ndarray], np.ndarray]):
            def slope(x: np.ndarray) -> tuple[float, np.ndarray]:
                found = losses(*parameters(x)) / total
                by_weight, by_intercept = found[1 : inner + 1].reshape(self.classes, FEATURES), found[inner + 1 :]
                by_weight = ((by_weight - by_intercept[:, None] * mean) * scale).ravel() + PENALTY * x[:inner]
                return found[0] + PENALTY / 2 * (x[:inner] @ x[:inner]), np.append(by_weight, by_intercept)

            return slope

        def everywhere(weights: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
            state = spark.sparkContext.broadcast((weights, intercepts))
            found = _sums(rows, lambda part: _loss(*state.value, part))
            state.unpersist()
            return found

        near = objective(self._near(rows))
        start = _least(near, np.zeros(inner + self.classes), 2 * PASSES, TOLERANCE)
        return parameters(_settled(objective(everywhere), near, start, PASSES, TOLERANCE))

    def _near(self, rows: DataFrame):
        """The loss with START_ROWS rows of label 0 in the place of all: it decides the way, not where it ends."""
        other = rows.where("label = 0")
        here = other.limit(START_ROWS).toArrow()
        share = max(1, other.count()) / max(1, here.num_rows)
        both = pa.concat_tables([here, rows.where("label > 0").toArrow()]).combine_chunks()
        weight = both.column("weight").to_numpy() * np.where(both.column("label").to_numpy() == 0, share, 1)
        batch = pa.RecordBatch.from_arrays([both.column("label").combine_chunks(), pa.array(weight), both.column("grams").combine_chunks()], names=["label", "weight", "grams"])
        return lambda weights, intercepts: _loss(weights, intercepts, batch)


@dataclass
class LicenseModel:
    weights: np.ndarray  # by class and feature
    intercepts: np.ndarray
    labels: list[str]
    threshold: float

    def likeliest(self, frame: DataFrame) -> DataFrame:
        """``frame(.., cued, content)`` by the pieces of a paragraph: .., piece, words, family, probability.

        Every piece of every paragraph is scored. Those most likely to be no notice are
        left out where the paragraph has no cue.
        """
        state = frame.sparkSession.sparkContext.broadcast((self.weights, self.intercepts))
        labels, n = pa.array(self.labels), len(frame.columns) - 2
        names = [*frame.columns[:n], "piece", "words", "family", "probability"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches):
                cued = part.column("cued").to_numpy(zero_copy_only=False)
                pieces = _pieces_of(part.column("content"), cut=True)
                if not len(pieces.row):
                    continue
                shares = _shares(_margins(*state.value, *pieces.grams()))
                best = shares.argmax(0)
                kept = np.flatnonzero((best > 0) | cued[pieces.row])
                rows = pa.array(pieces.row[kept])
                found = [pa.array(pieces.number[kept].astype(np.int32)), pieces.texts(kept), labels.take(pa.array(best[kept])), pa.array(shares.max(0)[kept])]
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in part.columns[:n]), *found], names=names)

        schema = StructType(list(frame.schema.fields[:n])).add("piece", IntegerType()).add("words", StringType())
        return frame.mapInArrow(run, schema.add("family", StringType()).add("probability", DoubleType()))


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, weight, grams) of rows with their text last."""
    for part in slices(batches):
        _, _, sizes, features = _grams(part.column("text"), cut=False)
        yield pa.RecordBatch.from_arrays([part.column("label"), part.column("weight"), _packed(sizes, features)], names=["label", "weight", "grams"])


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, piece, grams, head) of the pieces of paragraphs ``(h, content)``.

    ``head`` has the first words of the AROUND paragraphs of smallest hash of a slice.
    """
    for part in slices(batches):
        row, number, sizes, features = _grams(part.column("content"), cut=True)
        h = part.column("h").to_numpy()[row]
        least = np.unique(h)[:AROUND]
        head = np.full(len(row), None, dtype=object)
        for i in np.flatnonzero((number == 0) & np.isin(h, least)):
            folded = _FOLDED[np.frombuffer(part.column("content")[int(row[i])].as_buffer(), dtype=np.uint8)].tobytes()
            head[i] = " ".join(folded.decode("ascii").split()[:AROUND_WORDS])
        yield pa.RecordBatch.from_arrays(
            [pa.array(h), pa.array(number.astype(np.int32)), _packed(sizes, features), pa.array(head, pa.string())], names=["h", "piece", "grams", "head"]
        )


def _calibrated(state):
    """(h, piece, share) of the pieces of paragraphs ``(h, content)``: the share of a family, or of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            row, number, sizes, features = _grams(part.column("content"), cut=True)
            shares = _shares(_margins(*state.value, sizes, features))
            best = shares.max(0) if len(row) else np.zeros(0)
            share = np.where(shares.argmax(0) == 0, 1 - best, best) if len(row) else best
            yield pa.RecordBatch.from_arrays([pa.array(part.column("h").to_numpy()[row]), pa.array(number.astype(np.int32)), pa.array(share)], names=["h", "piece", "share"])

    return run


def train(documents: DataFrame, key: str = "doc_id", text: str = "text") -> LicenseModel:
    """A multinomial regression on word n-grams, and the level under which it says unknown.

    Positives are the templates: whole, their halves, and each inside other text.
    Negatives are all distinct paragraphs of the corpus without cue and of 40 characters
    or more, whole, in the pieces they are scored in; those of even hash are trained on
    and the others calibrated with. The level is the share of a family that all but
    FALSE_SHARE of the calibration half stay under. Only the eight texts put around the
    templates are picked, from the trained paragraphs of smallest hash. Where there are
    no negatives, a text without words is one, so that unknown words make no family likely.

    Of the trained half the features travel and are stored, of the other half only the
    shares: no text is shuffled.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col(text).alias("text"), _may_have_cue(F.col(text)).alias("cued"))
    lines = texts.select("cued", F.explode(F.split("text", "\n")).alias("content")).select("cued", F.xxhash64("content").alias("h"), "content")

    def half(odd: int) -> DataFrame:
        kept = (F.pmod("h", F.lit(2)) == odd) & (F.length("content") >= 40) & ~(F.col("cued") & F.col("content").rlike(CUES))
        return lines.where(kept).select("h", "content")

    found = half(0).mapInArrow(_learned, "h bigint, piece int, grams binary, head string")
    negatives = stored(found.groupBy("h", "piece").agg(F.min("grams").alias("grams"), F.max("head").alias("head")), "negatives")
    around = negatives.where("head is not null").orderBy("h").limit(AROUND).select(F.split("head", " ").alias("words"))
    around = around.select(F.slice("words", 1, 12).alias("before"), F.slice("words", 13, 12).alias("after"))
    n, middle = F.size("words"), F.floor((F.size("words") + 1) / 2).cast("int")
    whole = _templates(spark)
    positives = whole.unionByName(whole.where(n >= 12).select("family", F.slice("words", 1, middle).alias("words"))).unionByName(
        whole.where(n >= 12).select("family", F.slice("words", middle, middle).alias("words"))
    )
    inside = positives.join(F.broadcast(around)).select("family", F.concat("before", "words", "after").alias("words"))
    data = positives.withColumn("weight", F.lit(4.0)).unionByName(inside.withColumn("weight", F.lit(1.0)))
    labels = [NONE, *TEMPLATES]
    names = F.array(*[F.lit(label) for label in labels])
    data = data.select((F.array_position(names, F.col("family")) - 1).cast("int").alias("label"), "weight", F.array_join("words", " ").alias("text"))
    data = stored(data.coalesce(1).mapInArrow(_word_sets, "label int, weight double, grams binary"), "training")
    n_negatives = negatives.count()
    each = min(1.0, NEGATIVE_WEIGHT / max(1, n_negatives))
    if n_negatives:
        other = negatives.select(F.lit(0).alias("label"), F.lit(each).alias("weight"), "grams")
    else:
        other = spark.createDataFrame([(0, 4.0, b"")], data.schema)
    rows = data.unionByName(other)
    model = LicenseModel(*LogisticRegression(len(labels)).fit(rows), labels, 0.5)
    given = spark.sparkContext.broadcast((model.weights, model.intercepts))
    held = half(1).mapInArrow(_calibrated(given), "h bigint, piece int, share double")
    model.threshold = min(0.95, _level(held.groupBy("h", "piece").agg(F.max("share").alias("share")).select("share")))
    return model


def _level(shares: DataFrame) -> float:
    """The least multiple of 1 / LEVELS, from 0.5, that all but FALSE_SHARE of the shares stay under.

    Shares are counted by cells of that width: the driver gets a row per cell.
    """
    cells = shares.groupBy(F.floor(F.col("share") * LEVELS).cast("int").alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    beyond, allowed = 0, int(FALSE_SHARE * sum(r["n"] for r in cells))
    for r in sorted(cells, key=lambda r: -r["cell"]):
        beyond += r["n"]
        if beyond > allowed:
            return max(0.5, (r["cell"] + 1) / LEVELS)
    return 0.5


def _pieces(words: Column) -> Column:
    """A paragraph as it is, or in overlapping pieces if it is long: ``_pieces_of`` in SQL."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - STRIDE, F.lit(1)), F.lit(STRIDE))
    return F.when(F.size(words) <= PIECE, F.array(words)).otherwise(F.transform(starts, lambda i: F.slice(words, i, PIECE)))


def _likeness(words: Column, family: Column) -> Column:
    """The best containment of word pairs between the piece and a template of the family."""
    pairs = F.array_distinct(word_pairs(words))
    best = F.lit(0.0)
    for name, notices in TEMPLATES.items():
        of_family = []
        for notice in notices:
            known = F.array_distinct(word_pairs(paragraph_words(F.lit(notice))))
            of_family.append(F.size(F.array_intersect(pairs, known)) / F.greatest(F.least(F.size(known), F.size(pairs)), F.lit(1)))
        best = F.when(family == name, F.greatest(*of_family)).otherwise(best)
    return best


def license_notices(documents: DataFrame, key: str = "doc_id", text: str = "text", model: LicenseModel | None = None) -> DataFrame:
    """(doc_id, paragraph, family, probability, likeness, confirmed) per paragraph and family found in it.

    A paragraph is a line. All paragraphs of all texts are scored, long ones in
    overlapping pieces of 64 words; a family's likeliest piece speaks for it.
    ``family`` is the classifier's, or ``unknown`` if the probability is under the
    calibrated level, but not beside an overlapping piece that is above it with the
    same family. A paragraph without notice gives no row, or one of family ``none`` if
    it has a word that notices use. ``confirmed`` is true if a template of the family
    has at least half of its word pairs in common with the piece.

    Defined cases: NULL and empty texts have no notices. NULL keys and repeated
    rows are kept, a row each. An empty table gives no rows and trains on templates
    alone. Other columns are not looked at.
    """
    model = model or train(documents, key, text)
    texts = documents.select(F.col(key).alias("key"), F.col(text).alias("text"), _may_have_cue(F.col(text)).alias("cued"))
    rows = paragraphs(texts, "key", "text", "cued").withColumn("row", F.monotonically_increasing_id())
    cued = F.col("cued") & F.col("content").rlike(CUES)
    pieces = stored(model.likeliest(rows.select("row", "doc_id", "paragraph", cued.alias("cued"), "content")), "pieces")
    judged = pieces.withColumn("likeness", _likeness(F.split("words", " "), F.col("family")))
    found = F.when((F.col("family") != NONE) & (F.col("probability") < model.threshold), UNKNOWN).otherwise(F.col("family"))
    named, unknown = ~F.col("found").isin(NONE, UNKNOWN), F.col("found") == UNKNOWN
    in_order = Window.partitionBy("row").orderBy("piece")

    def same(at: Callable[[str], Column]) -> Column:
        """The next piece to one side names the family that this one is likeliest of."""
        near = (F.abs(at("piece").over(in_order) - F.col("piece")) == 1) & (at("found").over(in_order) == F.col("family"))
        return F.coalesce(near, F.lit(False))

    judged = judged.withColumn("found", found).withColumn("speaks", named | (unknown & ~same(F.lag) & ~same(F.lead)))
    judged = judged.withColumn("any", F.max("speaks").over(Window.partitionBy("row"))).where(F.col("speaks") | ~F.col("any"))
    best = F.max(F.struct("likeness", "probability")).alias("best")
    return judged.groupBy("row", "found").agg(F.first("doc_id").alias("doc_id"), F.first("paragraph").alias("paragraph"), best).select(
        "doc_id", "paragraph", F.col("found").alias("family"), "best.probability", "best.likeness", (F.col("best.likeness") >= CONFIRM_FROM).alias("confirmed")
    )
