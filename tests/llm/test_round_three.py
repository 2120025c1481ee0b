"""Prefix trie, SentencePiece spans and source divergence against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_tables import documents, rows  # noqa: F401

from daybook.llm.divergence import pair_sums, runs, shares, source_divergence
from daybook.llm.pieces import CharacterMap, Encoder, Normalizer, encode_batch, model_bytes, piece_spans
from daybook.llm.prefix_trie import MessageQueue, prefix_trie
from daybook.llm.queries import QUERIES

CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


# Prefix trie


def brute_trie(turns):
    """{(conv_id, depth): row} by walking every rebuilt conversation."""
    own = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        rebuilt[conv] = own.get(conv - int(math.fmod(conv, 100)), [])[:h] + mine[h:]
    members = {}
    for conv, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(conv)
    out = {}
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        children = {n for n in below if len(n) == len(node) + 1}
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out[min(convs), len(node)] = (min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, digest)
    return sorted(out.values())


def odd_turns():
    rng = np.random.default_rng(3)
    turns = [(c, t, ["user", None, "bot"][t % 3], ["a", "b", "", None, "čau 🙂"][int(rng.integers(5))]) for c in range(0, 260) for t in range(int(rng.integers(0, 9)))]
    turns += [(c, t, "user", "same") for c in range(300, 420) for t in range(7)]  # one conversation many times
    turns += [(500, t, "user", f"long {t % 4}") for t in range(90)]  # one long conversation
    turns += [(None, 1, "user", "x"), (701, None, None, None), (701, None, "z", "y"), (702, 1, "u", "t"), (702, 1, "u", "t"), (-5, 0, "u", "v")]
    return turns


@pytest.mark.parametrize("limits", [{}, {"width": 4, "height": 5, "range_turns": 60, "in_memory": 3}])
def test_trie_equals_brute_force(spark, limits):
    turns = odd_turns()
    table = spark.createDataFrame(turns, CONVERSATIONS).selectExpr("*", "'x' AS depth", "1 AS conv").repartition(3)
    assert sorted(rows(prefix_trie(table, **limits))) == brute_trie(turns)


def test_trie_of_an_empty_table(spark):
    out = prefix_trie(spark.createDataFrame([], CONVERSATIONS))
    assert out.count() == 0 and out.columns[0] == "conv_id"


def test_queue_merges_what_it_wrote_out():
    rng = np.random.default_rng(1)
    queue, sent = MessageQueue(5), [(int(p), i) for i, p in enumerate(rng.integers(0, 40, 300))]
    for place, i in sent:
        queue.push((place,), (i,))
    for place in range(40):
        assert sorted(m[0] for m in queue.take((place,))) == [i for p, i in sent if p == place]


# SentencePiece

ODD_TEXTS = [
    "", None, " ", "  ", "a", " a", "a ", "a  b", "▁x ▁", "é\x00 日本語 🙂🙂", "\n\n a\t b  \n", "x▁y", "  ▁▁ a", "<s> </s> <0x41> <unk>", "㍿ ｱ é",
    "word " * 5000 + " " * 3000 + "x" * 3000,
]


@pytest.fixture(scope="module")
def processor():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_proto=model_bytes())


def test_pieces_and_spans_equal_the_library(processor):
    encoder = Encoder(model_bytes())
    ids, starts, stops, first = encode_batch(encoder, pa.array(ODD_TEXTS, pa.string()))
    for i, text in enumerate(ODD_TEXTS):
        own = slice(first[i], first[i + 1])
        expected = processor.encode(text or "", return_type="proto").pieces
        assert ids[own].tolist() == [p.id for p in expected]
        assert list(zip(starts[own].tolist(), stops[own].tolist(), strict=True)) == [(p.begin, p.end) for p in expected]


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
def test_normaliser_follows_the_character_map(rule):
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    library, spec = SentencePieceNormalizer(rule_name=rule), sentencepiece_model_pb2.NormalizerSpec()
    spec.ParseFromString(library.serialized_normalizer_spec())
    own = Normalizer(spec)
    for text in filter(None, ODD_TEXTS):
        out, places = own.normalize(np.frombuffer(text.encode(), dtype=np.uint8))
        expected, chars = library.normalize(text, with_offsets=True)
        assert out.tobytes().decode() == expected
        lead = [i for i, byte in enumerate(out) if byte & 0xC0 != 0x80] + [len(out)]
        assert [int(places[i]) for i in lead] == [len(text[:c].encode()) for c in chars]


def test_an_empty_map_has_no_starts():
    assert CharacterMap(b"").may_start is None


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(model_bytes())
    proto.trainer_spec.byte_fallback = False
    with pytest.raises(ValueError, match="byte fallback"):
        Encoder(proto.SerializeToString())
    with pytest.raises(FileNotFoundError, match="give its path"):
        model_bytes("/nowhere/x.model")


def test_spans_join_up_and_rows_are_kept(spark, documents):
    texts = ["ein Text", None, "", "ein Text", "日本 x"]
    table = documents(*[(None if i == 3 else i, t) for i, t in enumerate(texts)], extra="ids decoded")
    out = piece_spans(table).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 0), (False, 1), (False, 2), (False, 4), (True, 0)]
    for r in out:
        size = len((texts[3 if r.doc_id is None else r.doc_id] or "").encode())
        assert r.starts[1:] == r.stops[:-1] and (not r.ids or (r.starts[0], r.stops[-1]) == (0, size))
    assert piece_spans(table.limit(0)).count() == 0


def test_every_document_equals_the_library(spark, small, processor):
    found = {r.doc_id: tuple(r) for r in QUERIES["op12_sentencepiece"](spark, small).collect()}
    for doc in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect():
        ids = processor.encode(doc.text or "")
        hashes = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), processor.decode(ids))]
        assert found.pop(doc.doc_id) == (doc.doc_id, len(ids), *hashes)
    assert not found


# Source divergence


def brute_divergence(docs, least=3, top=200):
    words = [(lang or "", source or "", [w.translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})) for w in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]) for text, lang, source in docs]
    out = []
    for lang in {w[0] for w in words}:
        own = [w for w in words if w[0] == lang]
        seen = Counter(t for _, _, ws in own for t in set(ws))
        kept = [t for t, n in seen.items() if n >= least]
        groups = {s: Counter() for _, s, _ in own}
        for _, s, ws in own:
            groups[s].update(t for t in ws if seen[t] >= least)
        total = sum(groups.values(), Counter())
        share = lambda counts: {t: 1 + 10**9 * (counts[t] + 1) // (sum(counts.values()) + len(kept)) for t in kept}
        p = {s: share(c) for s, c in groups.items()}
        whole = share(total)
        f = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            parts = {
                "pair": [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s],
                "term": [(t, f(p[s][t], whole[t])) for t in kept if groups[s][t] and p[s][t] > whole[t]],
            }
            for part, values in parts.items():
                ranked = sorted(values, key=lambda v: (-v[1], v[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(ranked) if part == "pair" or i < top]
    return sorted(out)


def test_divergence_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["a", "B", "b", "Éa", "éa", "x1y", "žluť", "🙂", "it's", *[f"w{'abcdefghij'[i % 10]}{'klmnop'[i % 6]}" for i in range(60)]]
    docs = [(" ".join(rng.choice(vocabulary, int(rng.integers(0, 40)))), ["en", "de", None][i % 3], ["s", "t", "", None, "ü"][int(rng.integers(5))]) for i in range(90)]
    docs += [(None, "fr", "only"), ("", "fr", "other"), ("rare words here", "xx", "s"), ("same same", "en", "s"), ("same same", "en", "s"), ("same " * 5000, "en", "t")]
    table = spark.createDataFrame(docs, "text string, lang string, source string").selectExpr("*", "1 AS n", "'x' AS term").repartition(4)
    assert sorted(rows(source_divergence(table))) == brute_divergence(docs)
    assert sorted(rows(source_divergence(table, top=3, range_words=7))) == brute_divergence(docs, top=3)


def test_divergence_of_an_empty_table(spark):
    assert source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


def test_runs_and_pairs_equal_dense_columns():
    rng = np.random.default_rng(2)
    for _ in range(50):
        size = int(rng.integers(1, 12))
        bounds = np.concatenate(([0], np.cumsum(rng.integers(1, 4, size))))
        dense = rng.integers(0, 3, (3, size))
        columns = []
        for counts in dense:
            at = np.flatnonzero(counts)
            starts, values = runs(at, counts[at], bounds)
            assert (np.diff(values) != 0).all() and starts[0] == 0
            columns.append((starts, shares(values, 17)))
        wide = [np.repeat(shares(c, 17), np.diff(bounds)) for c in dense]
        expected = [[((a - b) ** 2 // b).sum() if i != j else 0 for j, b in enumerate(wide)] for i, a in enumerate(wide)]
        assert pair_sums(columns, int(bounds[-1])).tolist() == np.array(expected).tolist()


def test_shares_are_exact_beyond_64_bits():
    assert shares(np.array([10**12]), 3 * 10**12).tolist() == [1 + 10**9 * (10**12 + 1) // (3 * 10**12)]
