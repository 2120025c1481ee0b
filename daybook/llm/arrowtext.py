"""Words and their 64-bit hashes of whole Arrow string columns, in numpy.

Words are maximal runs of bytes other than space and 0x09-0x0D. Those are ASCII, so
working on UTF-8 bytes equals working on code points. A hash is polynomial over the
bytes modulo 2^64, then mixed; equal words have equal hashes in every worker.
Memory: a fixed window of bytes at a time plus eight bytes per word of the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20
_BASE = 0x9E3779B97F4A7C55
_MASK = (1 << 64) - 1

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]

class _Powers:
    """base^i and base^-i modulo 2^64, as far as asked for; not sent along with code."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def tables(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= size:
            size = max(size, WINDOW) + 1
            self.up, self.down = (self._table(b, size) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        return np.cumprod(table)


_powers = _Powers()


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of the rows) of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if len(offsets) == 0 or data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: int = -1, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many bytes of the text column, or one row.

    What a slice needs in memory then depends on neither the rows of a batch nor how
    long its other texts are.
    """
    for batch in batches:
        column = text % batch.num_columns
        _, offsets = buffers(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1, at + 1)
            yield batch.slice(at, to - at)
            at = to


def spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words; a word ends with its row at the latest."""
    if len(data) == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inside = ~space[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """One hash per word, a window of bytes at a time; words are never cut."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _LOWER if lower else _BYTES
    at = 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + WINDOW, side="right"))
        to = max(to, at + 1)
        origin, size = starts[at], int(ends[to - 1] - starts[at])
        up, down = _powers.tables(size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(table[data[origin : origin + size]] * up[:size], out=sums[1:])
        s, e = starts[at:to] - origin, ends[at:to] - origin
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(_BASE))
        at = to
    return out


def words_of(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, index of each row's first word and the end)."""
    data, offsets = buffers(column)
    starts, ends = spans(data, offsets)
    return word_hashes(data, starts, ends, lower), np.searchsorted(starts, offsets)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words; a shorter non-empty text is one run."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    count = len(words) - size + 1
    h = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        h = (h + words[i : i + count]) * np.uint64(0xC2B2AE3D27D4EB4F)
        h ^= h >> np.uint64(29)
    return mix(h + np.uint64(size))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
