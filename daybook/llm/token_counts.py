"""Tokens of whole documents attributed to their sections (operator 2)."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrowtext import slices

#: Vocabulary file of ranks (a byte string in base 64 and its rank a line).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary's texts are cut into pieces before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "most")
#: White space runs of so many characters are cut off before the pattern sees them: it
#: steps back through a run, and a million steps end the process.
LONG_RUN = 10_000
_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encoder(ranks: bytes, pieces: str):
    """The encoding, and the bytes that each of its tokens stands for."""
    import tiktoken

    table = {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in ranks.splitlines() if line)}
    length = np.zeros(max(table.values()) + 1, dtype=np.int64)
    for word, rank in table.items():
        length[rank] = len(word)
    return tiktoken.Encoding("ranks", pat_str=pieces, mergeable_ranks=table, special_tokens={}), length


def encode(encoding, value: str, pieces: str = PIECES) -> list[int]:
    """The tokens of a text, its long white space runs given as the pieces they are.

    A run's piece is the run without its last character, or all of it at the text's
    end. Other patterns than PIECES may cut runs elsewhere; their texts go in whole.
    """
    tokens, at = [], 0
    for run in _RUN.finditer(value) if pieces == PIECES else ():
        end = run.end() if run.end() == len(value) else run.end() - 1
        tokens += encoding.encode_ordinary(value[at : run.start()])
        tokens += encoding._encode_single_piece(value[run.start() : end])
        at = end
    return tokens + encoding.encode_ordinary(value[at:])


def sections(data: np.ndarray, separator: int = 10) -> np.ndarray:
    """Byte bounds of the sections of a text: each ends after its separator."""
    cuts = np.flatnonzero(data == separator) + 1
    bounds = np.concatenate(([0], cuts, [len(data)]))
    return bounds[:-1] if len(cuts) and cuts[-1] == len(data) else bounds


def attribute(stops: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens of them that cross a bound) per section.

    Both lists are sorted, so the interval join is a merge: tokens are given by their
    ends (each starts where the one before ends), sections by their bounds.
    """
    n = len(bounds) - 1
    if len(stops) == 0:
        return np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    starts = np.concatenate(([0], stops[:-1]))
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, stops, side="left") - 1
    crossing = last > first
    owner = first
    if rule == "most" and crossing.any():
        owner = first.copy()
        for t in np.flatnonzero(crossing):
            edges = np.clip(bounds[first[t] : last[t] + 2], starts[t], stops[t])
            owner[t] = first[t] + int(np.diff(edges).argmax())
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def token_counts(
    documents: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, rule: str = "first", pieces: str = PIECES
) -> DataFrame:
    """(doc_id, section, start, stop, n_tokens, n_crossing) per section of each row.

    A section is a line with its line break; places are code points, stop exclusive.
    Each text is encoded once, with the tokens it has as a whole; a token stands for known bytes, so its
    span follows from the lengths. A token that crosses a bound counts wholly for the
    section of its first byte (``first``) or of most of its bytes (``most``; of equal
    parts the first), and in that section's ``n_crossing``. So sections add up to the
    document.

    ``vocabulary`` is a path the driver reads; the file's bytes are sent to the tasks.

    Defined cases: NULL and empty texts give one empty section without tokens. NULL
    keys and repeated rows are kept. Other columns are not looked at.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    ranks = documents.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        for batch in batches:
            if encoding is None:
                encoding, length = encoder(ranks.value, pieces)
            for part in slices([batch]):
                rows: list[list[np.ndarray]] = [[] for _ in range(6)]
                for i, value in enumerate(part.column("text").to_pylist()):
                    data = np.frombuffer((value or "").encode(), dtype=np.uint8)
                    tokens = np.array(encode(encoding, value, pieces), dtype=np.int64) if value else np.zeros(0, dtype=np.int64)
                    bounds = sections(data)
                    counts, crossing = attribute(np.cumsum(length[tokens]), bounds, rule)
                    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[bounds]
                    n = len(counts)
                    for column, v in zip(rows, (np.full(n, i), np.arange(n), chars[:-1], chars[1:], counts, crossing), strict=True):
                        column.append(v)
                flat = [np.concatenate(c) for c in rows]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(flat[0])), *(pa.array(v, pa.int64()) for v in flat[1:])],
                    names=["doc_id", "section", "start", "stop", "n_tokens", "n_crossing"],
                )

    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, section bigint, start bigint, stop bigint, n_tokens bigint, n_crossing bigint")


def document_tokens(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, n_sections, n_tokens, n_crossing) per document id."""
    return token_counts(documents, **options).groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_sections"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_crossing").alias("n_crossing")
    )
