"""SentencePiece encoding that keeps the place of every piece in the original (operator 12).

A text is normalised by longest prefixes of the model's compiled character map; each
normalised byte keeps the original byte it comes from. The normalised text is cut where
no piece can lie across (before a run of word marks), each distinct stretch of a batch
is encoded once, and the pieces' byte lengths project every piece to original bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.arrowtext import buffers, slices

MODEL = "piece_bpe_32k.model"
#: Fixed value: the sign that stands for a space in pieces, in UTF-8.
MARK = "▁".encode()
#: Bytes of text that are normalised and encoded together, or one text.
TOGETHER = 2 << 20
_SPACE = 0x20
_BYTE_PIECE, _USER_PIECE, _BPE = 6, 4, 2


def model_bytes(model: str = MODEL) -> bytes:
    """The model's file: a path, or a name among the installed vocabulary files."""
    if "/" not in model:
        import public_tokenizers

        model = public_tokenizers.path(model)
    try:
        with open(model, "rb") as file:
            return file.read()
    except FileNotFoundError as missing:
        raise FileNotFoundError(f"no sentencepiece model at {model}; give its path") from missing


class CharacterMap:
    """The compiled map: a double-array trie of byte strings to replacements."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], dtype="<u4").tolist()
        self.replacements = blob[4 + size :]
        self.may_start = self._starts()

    def _step(self, node: int, byte: int) -> int | None:
        """The node below by a byte; a unit holds its label and where its children are."""
        at = node ^ byte
        if at >= len(self.units) or self.units[at] & 0x800000FF != byte:
            return None
        return at ^ self._offset(self.units[at])

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def _is_leaf(self, node: int, byte: int) -> bool:
        return bool(self.units[node ^ byte] >> 8 & 1)

    def _starts(self) -> np.ndarray | None:
        """Whether a match may begin at two given bytes; the byte 256 is the end."""
        if not self.units:
            return None
        out = np.zeros((256, 257), dtype=bool)
        root = self._offset(self.units[0])
        for first in range(1, 256):
            node = self._step(root, first)
            if node is None:
                continue
            if self._is_leaf(root, first):
                out[first] = True
            out[first, :256] |= [second > 0 and self._step(node, second) is not None for second in range(256)]
        return out

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest key that begins at a place."""
        node, found, end = self._offset(self.units[0]), None, at
        while end < len(data) and data[end]:
            below = self._step(node, data[end])
            if below is None:
                break
            if self._is_leaf(node, data[end]):
                found = end + 1 - at, self.units[below] & 0x7FFFFFFF
            node, end = below, end + 1
        if found is None:
            return None
        return found[0], self.replacements[found[1] : self.replacements.index(b"\0", found[1])]


class Normalizer:
    """Normalised bytes of a text, and the original place of each."""

    def __init__(self, spec) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def _replaced(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes after the character map, and the first byte of the character (or of the
        matched key) that each stands for."""
        lead = (data & 0xC0) != 0x80
        origin = np.maximum.accumulate(np.where(lead, np.arange(len(data)), 0))
        if self.map.may_start is None:
            return data, origin
        following = np.append(data[1:].astype(np.int64), 256)
        text, parts, places, at = data.tobytes(), [], [], 0
        for start in np.flatnonzero(lead & self.map.may_start[data, following]).tolist():
            if start < at:
                continue
            match = self.map.longest(text, start)
            if match is None:
                continue
            length, by = match
            parts += [data[at:start], np.frombuffer(by, dtype=np.uint8)]
            places += [origin[at:start], np.full(len(by), start)]
            at = start + length
        return np.concatenate([*parts, data[at:]]), np.concatenate([*places, origin[at:]])

    def normalize(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(normalised bytes, their original places and the end of what was read).

        With ``remove_extra_whitespaces`` a run of spaces counts as its first and runs
        at both ends go; an empty text stays empty, without a prefix.
        """
        end = len(data)
        if end == 0:
            return data, np.zeros(1, dtype=np.int64)
        out, places = self._replaced(data)
        if self.squeeze:
            space = out == _SPACE
            kept = ~space
            kept[1:] |= ~space[:-1]
            kept[0] = not space[0] if len(out) else False
            out, places = out[kept], places[kept]
            if len(out) == 0:
                return out, np.zeros(1, dtype=np.int64)
        if self.prefix:
            out, places = np.concatenate(([_SPACE], out)).astype(np.uint8), np.concatenate((places[:1], places))
        if self.escape:
            space = out == _SPACE
            size = np.where(space, len(MARK), 1)
            first = np.cumsum(size) - size
            places = np.repeat(places, size)
            wide = np.repeat(out, size)
            for i, byte in enumerate(MARK):
                wide[first[space] + i] = byte
            out = wide
        if self.squeeze:
            sign, size = (MARK if self.escape else b" "), len(out)
            while out[:size][-len(sign) :].tobytes() == sign:
                size -= len(sign)
            if size < len(out):
                out, places, end = out[:size], places[:size], int(places[size])
        return out, np.append(places, end)


class Encoder:
    """A model's pieces over normalised text, distinct stretches encoded once."""

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self._check(proto)
        self.normalizer = Normalizer(proto.normalizer_spec)
        self.whole = SentencePieceProcessor(model_proto=model)
        self.lengths = np.array([1 if p.type == _BYTE_PIECE else len(p.piece.encode()) for p in proto.pieces], dtype=np.int64)
        mark = MARK.decode()
        self.joins = any(mark in p.piece.lstrip(mark) for p in proto.pieces)
        # the same pieces over text that is normalised already
        plain = proto.normalizer_spec
        plain.precompiled_charsmap, plain.add_dummy_prefix, plain.remove_extra_whitespaces = b"", False, False
        self.pieces = SentencePieceProcessor(model_proto=proto.SerializeToString())

    @staticmethod
    def _check(proto) -> None:
        train = proto.trainer_spec
        if train.model_type != _BPE or not train.byte_fallback or train.treat_whitespace_as_suffix:
            raise ValueError("the model has to be BPE with byte fallback and word marks in front")
        if any(p.type == _USER_PIECE for p in proto.pieces):
            raise ValueError("models with user-defined pieces are not supported")

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the stretches, and the end: each text, and each run of marks that
        follows something else, unless some piece has a mark inside."""
        begins = np.zeros(len(data) + 1, dtype=bool)
        if not self.joins and len(data) >= len(MARK):
            begins[:-3] = (data[:-2] == MARK[0]) & (data[1:-1] == MARK[1]) & (data[2:] == MARK[2])
            begins[3:] &= ~begins[:-3].copy()
        begins[offsets] = True
        return np.flatnonzero(begins)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, index of each text's first id and the end) of normalised texts."""
        if len(data) == 0:
            return np.zeros(0, dtype=np.int64), np.zeros(len(offsets), dtype=np.int64)
        cuts = self._cuts(data, offsets)
        stretches = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data))
        coded = stretches.dictionary_encode()
        found = self.pieces.encode(coded.dictionary.to_pylist(), num_threads=1)
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        flat = np.fromiter(chain.from_iterable(found), dtype=np.int64, count=int(size.sum()))
        first = np.cumsum(size) - size
        codes = coded.indices.to_numpy()
        many = size[codes]
        ends = np.cumsum(many)
        ids = flat[np.arange(ends[-1]) - np.repeat(ends - many, many) + np.repeat(first[codes], many)]
        at = np.concatenate(([0], ends))
        return ids, at[np.searchsorted(cuts, offsets)]


def encode_batch(encoder: Encoder, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, start bytes, stop bytes, index of each text's first id and the end)."""
    data, offsets = buffers(column)
    each = [encoder.normalizer.normalize(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
    bounds = np.concatenate(([0], np.cumsum([len(out) for out, _ in each]))).astype(np.int64)
    ids, first = encoder.encode(np.concatenate([out for out, _ in each]) if each else data, bounds)
    ends = np.cumsum(encoder.lengths[ids])
    starts, stops = np.zeros(len(ids), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    for i, (_, places) in enumerate(each):
        a, b = first[i], first[i + 1]
        stop = ends[a:b] - bounds[i]
        stops[a:b] = places[stop]
        starts[a:b] = places[stop - encoder.lengths[ids[a:b]]]
    return ids, starts, stops, first


def piece_spans(documents: DataFrame, key: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """(doc_id, ids, starts, stops, decoded) of each row.

    ``ids`` are those of the library's ``encode`` without begin and end ids, ``decoded``
    is its ``decode(ids)``. ``starts`` and ``stops`` are bytes of the original text in
    UTF-8, stop exclusive: piece by piece they follow each other, and together cover
    what the normaliser read. The prefix mark stands for no byte. A character in byte
    pieces belongs to its last one, the others are empty and lie at its start; of a key
    of the character map that became several pieces the last one has all its bytes.

    ``model`` is a path that the driver reads, or a name among the installed vocabulary
    files; its bytes are sent to the tasks, so executors need no copy of the file.
    Texts are taken whole, some megabytes together; a text longer than that alone, with
    memory in proportion to its length (some ten times its bytes).

    Defined cases: NULL and empty texts have no ids and decode to an empty text. NULL
    keys and repeated rows are kept, a row each. Other columns are not looked at, also
    not those named like a result. An empty table gives no rows.
    """
    model_file = documents.sparkSession.sparkContext.broadcast(model_bytes(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for part in slices(batches, most=TOGETHER):
            encoder = encoder or Encoder(model_file.value)
            ids, starts, stops, first = encode_batch(encoder, part.column(1))
            decoded = [encoder.whole.decode(ids[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
            lists = [pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(v, t)) for v, t in ((ids, pa.int32()), (starts, pa.int32()), (stops, pa.int32()))]
            yield pa.RecordBatch.from_arrays([part.column(0), *lists, pa.array(decoded, pa.string())], names=["doc_id", "ids", "starts", "stops", "decoded"])

    rows = documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, starts array<int>, stops array<int>, decoded string")
