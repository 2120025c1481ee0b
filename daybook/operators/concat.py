"""Ordered string aggregation over counted copies.

Joining every string of a group moves each copy to one task. Counting copies per
(group, string) first combines them before the shuffle; they are written out
again only in the result.

A joined string that no task can hold is given in pieces, and read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators.cuts import sampled_cuts


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def repeated_in_order(value: str, copies: str, separator: str) -> Column:
    """Aggregate: every value ``copies`` times, sorted by value, NULL if none.

    NULL values are skipped, as the string aggregate itself does.
    """
    sep = quoted(separator)
    part = f"IF({value} IS NULL, NULL, array_join(array_repeat({value}, CAST({copies} AS INT)), {sep}))"
    return F.expr(f"listagg({part}, {sep}) WITHIN GROUP (ORDER BY {value})")


def joined_in_order(
    counted: DataFrame,
    keys: Sequence[str],
    value: str,
    copies: str,
    separator: str,
    range_texts: int,
    piece_bytes: int | None = None,
) -> DataFrame:
    """(keys.., joined): all values of a key in order, each ``copies`` times.

    For keys with very many texts: the texts of a key are dealt out in ranges of their
    order, sorted and joined per range, and the ranges' strings are put together, so no
    task sorts all texts of a key. ``counted`` should be a stored table, since the
    ranges are sampled from it first. NULL values are skipped; a key without any has
    NULL.

    With ``piece_bytes`` nothing is put together, for strings that a task cannot hold:
    (keys.., _range, _nth, _chars, _size, _piece) has the string of each range as its
    UTF-8 bytes in pieces of at most so many, compressed by zstd, in the order of
    (_range, _nth); between two ranges belongs a separator. NULL values give a NULL
    piece. A task holds one piece at a time, however long or often repeated a text is.
    """
    start = counted.withColumn("_start", F.substring(value, 1, 64))
    placed = sampled_cuts(start, keys, ["_start"], range_texts).place(start, "_range")
    if piece_bytes is not None:
        names = [*keys, "_range"]
        in_order = placed.repartition(*names).sortWithinPartitions(*names, value)
        texts = in_order.select(*names, F.col(value).cast("binary").alias("_text"), F.col(copies).cast("long").alias("_copies"))
        columns = "_nth long, _chars long, _size int, _piece binary"
        schema = T.StructType([*texts.select(*names).schema.fields, *T.StructType.fromDDL(columns).fields])
        return texts.mapInArrow(_into_pieces(len(names), separator.encode(), piece_bytes), schema)
    parts = placed.groupBy(*keys, "_range").agg(repeated_in_order(value, copies, separator).alias("_part"))
    in_order = F.sort_array(F.collect_list(F.when(F.col("_part").isNotNull(), F.struct("_range", "_part"))))
    texts = F.transform(in_order, lambda part: part["_part"])
    return parts.groupBy(*keys).agg(F.when(F.size(texts) > 0, F.array_join(texts, separator)).alias("joined"))


def digests_in_order(pieces: DataFrame, keys: Sequence[str], separator: str) -> DataFrame:
    """(keys.., n_chars, digest): length and MD5 of the strings that ``joined_in_order`` gave in pieces.

    MD5 takes its bytes one after another, so one task reads all pieces of a key, a few
    at a time. NULL where the string is.
    """
    names = list(keys)
    in_order = pieces.repartition(*names).sortWithinPartitions(*names, "_range", "_nth")
    columns = T.StructType.fromDDL("n_chars long, digest string").fields
    schema = T.StructType([*pieces.select(*names).schema.fields, *columns])
    return in_order.select(*names, "_range", "_chars", "_size", "_piece").mapInArrow(_into_digests(len(names), separator), schema)


Worker = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _into_pieces(n: int, separator: bytes, most: int) -> Worker:
    """Rows (n columns that name a range, text, copies), in order, to pieces of the ranges' strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=3)
        held, here, begun, nth, fields = bytearray(), None, False, 0, []

        def piece(group: tuple, data: bytearray | None) -> pa.RecordBatch:
            chars = size = packed = None
            if data is not None:
                chars, size = int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)), len(data)
                packed = codec.compress(bytes(data), asbytes=True)
            made = [pa.array([k], f.type) for k, f in zip(group, fields, strict=True)]
            rest = [pa.array([nth], pa.int64()), pa.array([chars], pa.int64()), pa.array([size], pa.int32()), pa.array([packed], pa.binary())]
            return pa.RecordBatch.from_arrays([*made, *rest], names=[*(f.name for f in fields), "_nth", "_chars", "_size", "_piece"])

        for batch in batches:
            fields = [batch.schema.field(i) for i in range(n)]
            groups = zip(*[batch.column(i).to_pylist() for i in range(n)], strict=True)
            for group, text, copies in zip(groups, batch.column(n), batch.column(n + 1).to_pylist(), strict=True):
                if group != here:
                    if begun:
                        yield piece(here, held)
                    held, here, begun, nth = bytearray(), group, False, 0
                if not text.is_valid:
                    yield piece(group, None)
                    nth += 1
                    continue
                data = memoryview(text.as_buffer())
                for _ in range(copies or 0):
                    for part in (memoryview(separator if begun else b""), data):
                        while len(held) + len(part) > most:
                            room = most - len(held)
                            held += part[:room]
                            part = part[room:]
                            yield piece(group, held)
                            held, nth = bytearray(), nth + 1
                        held += part
                    begun = True
        if begun:
            yield piece(here, held)

    return run


def _into_digests(n: int, separator: str) -> Worker:
    """Pieces (n key columns, range, chars, size, piece), in order, to a row per key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        here, within, chars, state, fields = None, None, 0, None, []

        def digest() -> pa.RecordBatch:
            made = [pa.array([k], f.type) for k, f in zip(here, fields, strict=True)]
            rest = [pa.array([chars if state else None], pa.int64()), pa.array([state.hexdigest() if state else None], pa.string())]
            return pa.RecordBatch.from_arrays([*made, *rest], names=[*(f.name for f in fields), "n_chars", "digest"])

        for batch in batches:
            fields = [batch.schema.field(i) for i in range(n)]
            groups = zip(*[batch.column(i).to_pylist() for i in range(n)], strict=True)
            others = (batch.column(n + i).to_pylist() for i in range(3))
            for group, at, length, size, piece in zip(groups, *others, batch.column(n + 3), strict=True):
                if group != here:
                    if here is not None:
                        yield digest()
                    here, within, chars, state = group, None, 0, None
                if not piece.is_valid:
                    continue
                if state is None:
                    state = hashlib.md5(usedforsecurity=False)
                elif at != within:
                    state.update(separator.encode())
                    chars += len(separator)
                within = at
                chars += length
                state.update(codec.decompress(piece.as_buffer(), size))
        if here is not None:
            yield digest()

    return run
