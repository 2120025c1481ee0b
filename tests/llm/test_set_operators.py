"""Operators that compare documents with each other, and the ones that deal them out."""

from __future__ import annotations

import random
from collections import Counter

import brute
import numpy as np
import pytest
from llm_tables import documents, rows  # noqa: F401
from pyspark.sql import functions as F

from daybook.llm import decontamination, line_dedup, lm_brown, mixing, ngram_jaccard, setjoin, sharding
from daybook.llm.graph import components

VOCABULARY = [f"w{i}" for i in range(400)]


def _text(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def _edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def _copies(seed=1):
    """Texts with copies, near copies around the threshold, a shared passage, and odd ones."""
    rng = random.Random(seed)
    base, passage = _text(rng, 120), _text(rng, 60)
    texts = [base, base.upper(), *[_edited(rng, base, rng.randint(1, 4)) for _ in range(90)]]
    texts += [f"{_text(rng, 40)} {passage} {_text(rng, 30)}" for _ in range(30)]
    texts += [_text(rng, n) for n in (1, 2, 4, 4, 5, 6, 300)] + ["a b", "a  b", "A b\n", "", None, "   "]
    long = _text(rng, 150)
    texts += [" ".join(long.split()[:n]) for n in range(100, 151, 5)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("common_from, home_from", [(12, 64), (2, 3), (10_000, 10_000)])
def test_components_equal_brute_force(spark, documents, monkeypatch, common_from, home_from):
    monkeypatch.setattr(setjoin.common_tokens, "__defaults__", (common_from, setjoin.MAX_COMMON))
    monkeypatch.setattr(setjoin, "HOME_FROM", home_from)
    data = [(1000 - 3 * i, t) for i, t in enumerate(_copies())]
    found = ngram_jaccard.ngram_jaccard(documents(*data, extra="key n component"))
    expected = {data[i][0]: c for i, c in brute.components(data).items()}
    got = {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in found.collect()}
    assert got == {key: (expected[key], len(brute.shingles(t))) for key, t in data}


def test_products_are_the_same_in_any_block_size(spark, documents, monkeypatch):
    data = list(enumerate(_copies(2)))
    expected = brute.components(data)
    monkeypatch.setattr(setjoin, "HOME_FROM", 3)
    monkeypatch.setattr(setjoin, "PRODUCT_ROWS", 7)
    found = ngram_jaccard.ngram_jaccard(documents(*data)).select("doc_id", "component_id")
    assert dict(rows(found)) == expected


def test_one_document_of_each_component_stays(documents, spark):
    text = "one two three four five six seven eight nine ten"
    data = [(5, text), (3, text), (3, text), (9, "something else that is on its own here"), (7, None), (8, ""), (8, "")]
    df = documents(*data, extra="component_key rep")
    kept = ngram_jaccard.one_per_component(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == [
        (3, text), (7, ""), (8, ""), (8, ""), (9, "something else that is on its own here"),
    ]
    no_key = spark.createDataFrame([(None, text), (1, text)], "doc_id bigint, text string")
    assert ngram_jaccard.one_per_component(no_key).count() == 2
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_jaccard.one_per_component(empty).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    found = dict(rows(components(spark.createDataFrame(links, "a bigint, b bigint"))))
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 120)}


# Benchmark passages


def _contaminated(texts, items):
    def words(text):
        clean = "".join(c if ord(c) > 127 or c.isalnum() else " " for c in (text or "").translate(brute.LOWER))
        return clean.split(" ") if clean else []

    out = []
    windows = [(name, w) for name, text in items for w in [[x for x in words(text) if x]] if w]
    windows = [(name, tuple(w[i : i + 10])) for name, w in windows for i in range(max(1, len(w) - 9))]
    for text in texts:
        w = [x for x in words(text) if x]
        hit, names = set(), set()
        for name, window in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    names.add(name)
        out.append((len(w), len(hit), sorted(str(n) for n in names if n is not None)))
    return out


@pytest.mark.parametrize("most", [decontamination.BROADCAST_ROWS, 3])
def test_hits_equal_brute_force(spark, documents, monkeypatch, most):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", most)
    rng = random.Random(4)
    items = [(i, _text(rng, n)) for i, n in enumerate((3, 9, 10, 11, 40))] + [(10, "Größe, a-b!"), (11, ""), (12, None), (None, _text(rng, 12)), (2, "x y")]
    texts = ["", None, "w1", "x, Y x-y", "größe A b", "GRÖßE a b"]
    for _, t in items:
        w = (t or "w2").split()
        texts += [f"{_text(rng, 5)} {' '.join(w[:12])}. {_text(rng, 4)}", " ".join(w).upper() + " " + " ".join(w), " ".join(w[1:9])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.contamination(documents(*enumerate(texts), extra="words token window_key"), benchmark)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in found.collect()}
    for i, (n, hit, names) in enumerate(_contaminated(texts, items)):
        assert got[i] == (n, hit, names, hit > 0), texts[i]
    clean = decontamination.without_benchmark(documents(*enumerate(texts)), benchmark)
    assert sorted(r["doc_id"] for r in clean.collect()) == [i for i in got if not got[i][3]]


def test_empty_benchmark_and_empty_documents(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    df = documents((1, "a b"), (1, "a b"))
    assert rows(decontamination.contamination(df, none).select("n_hit", "n_items")) == [(0, 0)] * 2
    assert decontamination.without_benchmark(df, none).count() == 2
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert decontamination.contamination(empty, none).collect() == []


# Lines


@pytest.mark.parametrize("cell, chunk", [(1 << 14, 1 << 18), (3, 20)])
def test_lines_equal_brute_force(documents, monkeypatch, cell, chunk):
    monkeypatch.setattr(line_dedup, "CELL", cell)
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    rng = random.Random(6)
    lines = [_text(rng, rng.randint(1, 25)) for _ in range(25)]
    texts = []
    for _ in range(40):
        own = [_edited(rng, rng.choice(lines), rng.randint(0, 2)) for _ in range(rng.randint(0, 6))]
        texts.append("\n".join(rng.choice([own, own + ["", " "], ["A b c", *own]])))
    texts += [None, "", "\n", "a\n\na"]
    data = [(2 * i, t) for i, t in enumerate(texts)]
    earlier, expected = [], {}
    for key, text in data:
        gone = []
        for number, line in enumerate((text or "").split("\n")):
            s = frozenset(brute.words(line, lower=True))
            if s and any(s == e for e in earlier):
                gone.append(number)
            elif s and any(brute.similar(s, e) for e in earlier):
                gone.append(number)
            if s:
                earlier.append(s)
        expected[key] = gone
    df = documents(*data, extra="line same near n_lines")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(df).collect()}
    assert got == expected
    left = line_dedup.without_repeated_lines(df)
    assert left.columns == df.columns
    for r in left.collect():
        text = dict(data)[r["doc_id"]]
        parts = (text or "").split("\n")
        assert (r["text"] or "") == "\n".join(x for i, x in enumerate(parts) if i not in expected[r["doc_id"]])


def _removed_lines(data):
    """{row index: numbers of the lines with an equal or similar earlier line} of (id, text) rows in order."""
    earlier, expected = [], {}
    for i, (_, text) in enumerate(data):
        sets = [frozenset(brute.words(line, lower=True)) for line in (text or "").split("\n")]
        gone = []
        for number, s in enumerate(sets):
            if s and any(s == e or brute.similar(s, e) for e in earlier):
                gone.append(number)
            if s:
                earlier.append(s)
        expected[i] = gone
    return expected


@pytest.mark.parametrize("cell, chunk, common_from", [(1 << 14, 1 << 18, 12), (12, 50, 2), (4, 7, 10_000)])
def test_lines_around_the_threshold_equal_brute_force(documents, monkeypatch, cell, chunk, common_from):
    monkeypatch.setattr(line_dedup, "CELL", cell)
    monkeypatch.setattr(line_dedup, "CHUNK", chunk)
    monkeypatch.setattr(setjoin, "COMMON_FROM", common_from)
    rng = random.Random(60)
    few = [f"v{i}" for i in range(14)]
    texts = []
    for size in (3, 4, 5, 8, 9, 10, 30, 90, 400):
        line = _text(rng, size)
        texts += ["\n".join(_edited(rng, line, rng.randint(0, max(1, size // 6))) for _ in range(5)) for _ in range(4)]
        texts += [" ".join(line.split()[: size - cut]) for cut in range(min(3, size))]
    texts += ["\n".join(" ".join(rng.sample(few, rng.randint(3, 12))) for _ in range(6)) for _ in range(15)]
    rng.shuffle(texts)
    data = list(enumerate(texts))
    got = {r["doc_id"]: r["removed"] for r in line_dedup.line_report(documents(*data)).collect()}
    assert got == _removed_lines(data)


def test_lines_of_odd_rows(spark):
    long = " ".join(f"word{i}" for i in range(60_000))
    df = spark.createDataFrame(
        [(None, "a b c d e"), (2, "a b c d e"), (1, long), (1, long), (3, long + " more"), (4, "f g h"), (4, "f g h")],
        "doc_id bigint, text string",
    )
    found = sorted((r["doc_id"] or 0, r["removed"]) for r in line_dedup.line_report(df).collect())
    assert found == [(0, []), (1, []), (1, []), (2, [0]), (3, [0]), (4, []), (4, [])]
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.line_report(empty).collect() == [] and line_dedup.without_repeated_lines(empty).collect() == []


# Scores


def test_brown_scores_learn_from_training_rows_and_beat_the_unigram(spark, documents):
    rng = random.Random(8)
    nouns, verbs = [f"noun{i}" for i in range(60)], [f"verb{i}" for i in range(60)]
    texts = [" ".join(w for _ in range(20) for w in (rng.choice(nouns), rng.choice(verbs))) for _ in range(300)]
    df = documents(*enumerate([*texts, None, "", "never seen WORDS"]), extra="word score text_key")
    found = lm_brown.brown_scores(df).toPandas().set_index("doc_id")
    held = found[found.held_out & (found.index < 300)]
    assert 0 < len(held) < 60
    assert held.score.sum() > held.base_score.sum() + 0.1 * held.n_tokens.sum()
    assert found.loc[300, "n_tokens"] == found.loc[301, "n_tokens"] == 1
    assert found.loc[300, "score"] == found.loc[301, "score"]
    assert found.loc[302, "n_tokens"] == 4 and found.loc[302, "n_known"] == (1 if found.loc[302, "held_out"] else 4)
    assert found.train_tokens.nunique() == 1
    spare = lm_brown.brown_scores(spark.createDataFrame([], "doc_id bigint, text string"))
    assert spare.collect() == []


def test_counts_beyond_the_lookup_are_joined(spark, documents, monkeypatch):
    rng = random.Random(9)
    data = list(enumerate(_text(rng, 50) for _ in range(60))) + [(60, "w1 w1"), (61, "w1 w1")]
    whole = lm_brown.brown_scores(documents(*data)).toPandas().set_index("doc_id").sort_index()
    monkeypatch.setattr(lm_brown, "LOOKUP", 20)
    monkeypatch.setattr(lm_brown, "CLUSTERED", 20)
    monkeypatch.setattr(lm_brown, "ROUNDS", 0)
    few = lm_brown.brown_scores(documents(*data)).toPandas().set_index("doc_id").sort_index()
    assert np.allclose(whole.base_score, few.base_score) and (whole.n_known == few.n_known).all()


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(2)
    matrix = rng.integers(0, 50, (lm_brown.ALL_CLASSES, lm_brown.ALL_CLASSES)).astype(float)
    right, left = rng.integers(0, 3, (2, lm_brown.ALL_CLASSES)).astype(float)
    own = 3
    matrix[own] += right
    matrix[:, own] += left
    to = lm_brown._best_class(matrix, own, right, left, 0.0)
    moved = matrix.copy()
    moved[own] -= right
    moved[:, own] -= left
    gains = []
    for b in range(lm_brown.CLASSES):
        m = moved.copy()
        m[b] += right
        m[:, b] += left
        gains.append(lm_brown._likelihood(m))
    assert to == int(np.argmax(gains))


# Mixing and shards


def test_mix_meets_every_target(spark, documents):
    rng = random.Random(12)
    data = [(i, _text(rng, rng.randint(0, 90)), rng.choice(["a", "b", "c", "d", "e", None, ""])) for i in range(300)]
    data += [(1000 + i, "one two three", "tiny") for i in range(3)] + [(2000, None, "b"), (2001, "", "void")]
    df = documents(*data, extra="size block shard place")
    found = mixing.mixture(df, df.columns, block_rows=16).collect()
    expected = brute.mixed(data)
    taken, dealt = Counter(), Counter()
    for r in found:
        source = r["row"]["source"]
        assert r["source_size"] == expected[source][0] and abs(r["target"] - expected[source][1]) < 1e-6
        assert r["taken"] <= 3 * r["size"] and r["size"] == len(brute.words(r["row"]["text"]))
        assert len({d["pass"] for d in r["draws"]}) == len(r["draws"])
        taken[source] += r["taken"]
        dealt.update(d["shard"] for d in r["draws"])
    assert all(abs(taken[s] - t) <= 0.5 for s, (_, t) in expected.items())
    assert set(dealt) == set(range(mixing.SHARDS))
    again = mixing.mixture(df.repartition(5), df.columns, block_rows=16).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_quotas_are_dealt_whole_and_evenly(spark):
    quotas = {"a": 1000, "b": 10, "c": 1}
    dealt = mixing.split_quotas(spark.createDataFrame(list(quotas.items()), "source_key string, k bigint"), shards=6)
    got = dealt.groupBy("source_key").agg(F.sum("k")).collect()
    assert dict(rows(dealt.groupBy("source_key").agg(F.sum("k")))) == quotas and len(got) == 3
    sizes = [r[1] for r in rows(dealt.groupBy("shard").agg(F.sum("k")))]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 2


def test_mixed_documents_and_written_shards(spark, documents, tmp_path):
    data = [(i, "w " * 10, "ab"[i % 2]) for i in range(200)]
    df = documents(*data, extra="row draws")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = Counter(r["source"] for r in out.collect())
    assert abs(copies["a"] - 200 / 3) <= 1 and abs(copies["b"] - 400 / 3) <= 1
    mixing.write_shards(df, str(tmp_path / "mix"))
    assert spark.read.parquet(str(tmp_path / "mix")).count() in range(199, 203)
    empty = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert mixing.mixed_documents(empty).collect() == []


def test_shards_fit_their_limit(documents, spark):
    data = [(i, "x" * (i % 50)) for i in range(2000)] + [(None, "y" * 30), (-1, "z" * 9000), (7, None), (7, "")]
    df = documents(*data, extra="shard bits depth")
    cut = sharding.sharded(df, limit=5000).collect()
    assert len(cut) == len(data)
    total, ids = Counter(), {}
    for r in cut:
        s = r["shard_"]
        total[s["id"]] += len(r["text"] or "")
        ids.setdefault(s["id"], s)
        assert s["depth"] == len(s["id"]) and r["shard"] == r["bits"] == "kept"
    assert all(total[k] == s["shard_bytes"] for k, s in ids.items())
    over = [k for k, t in total.items() if t > 5000]
    assert len(over) == 1 and total[over[0]] >= 9000 and ids[over[0]]["depth"] == sharding.BITS
    prefix_free = sorted(ids)
    assert not any(b.startswith(a) for a, b in zip(prefix_free, prefix_free[1:], strict=False))
    parents = {k[:-1] for k in ids if k}
    for p in parents:
        assert sum(t for k, t in total.items() if k.startswith(p)) > 5000
    assert sharding.sharded(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_rows_of_one_key_are_split_until_they_fit(documents):
    data = [(None, f"{i:03d}" + "n" * 97) for i in range(60)] + [(7, "c" * 400)] * 3 + [(8, "d" * 700), (8, "e" * 1500)]
    data += [(9, f"{i % 5}" * 100) for i in range(40)] + [(100 + i, "x" * 50) for i in range(50)]
    found = sharding.sharded(documents(*data, extra="key_bits number bits"), limit=1000).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in found))) == sorted(map(str, data))
    shards = {}
    for r in found:
        shards.setdefault(r["shard"]["id"], []).append(r)
    for name, members in shards.items():
        size = sum(len(r["text"]) for r in members)
        assert all((r["shard"]["shard_bytes"], r["shard"]["shard_rows"], r["shard"]["depth"]) == (size, len(members), len(name)) for r in members)
        assert size <= 1000 or len(members) == 1
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))


def test_words_are_ranked_and_ordered_as_by_plain_sorting():
    rng = np.random.default_rng(8)
    vocabulary = np.unique(rng.integers(-(1 << 63), 1 << 63, 3000))
    vocabulary[1:40] = vocabulary[0] + np.arange(1, 40)  # hashes with equal leading bits
    vocabulary = np.unique(vocabulary)
    known, rank = vocabulary[::3], rng.permutation(len(vocabulary[::3]))
    words = rng.choice(vocabulary, 20_000)
    lines = np.sort(rng.integers(0, 5000, len(words)))
    ranked = dict(zip(known.tolist(), rank.tolist(), strict=True))
    plain = np.array([ranked.get(w, w | -(1 << 63)) for w in words.tolist()])
    ranks = line_dedup._Ranks((known, rank))
    assert (ranks.tokens(words) == plain).all()
    found = plain[line_dedup._by_line(lines, plain)]
    assert (found == plain[np.lexsort((plain, lines))]).all()
    nothing = line_dedup._Ranks((known[:0], rank[:0]))
    assert (nothing.tokens(words) == (words | -(1 << 63))).all()
    assert len(line_dedup._by_line(lines[:0], plain[:0])) == 0


@pytest.mark.parametrize("few", [0, 1 << 20])
def test_lines_of_rows_without_key_come_first_and_repeated_rows_are_one_document(documents, monkeypatch, few):
    monkeypatch.setattr(line_dedup, "FEW", few)
    long = " ".join(f"w{i}" for i in range(60_000))
    line = " ".join(f"v{i}" for i in range(20))
    data = [(None, f"{line}\nown words of a row"), (7, f"x\n{line} more"), (7, f"x\n{line} more"), (9, long), (12, f"{long} end\nx")]
    got = sorted((str(r["doc_id"]), r["n_lines"], r["n_same"], r["removed"]) for r in line_dedup.line_report(documents(*data)).collect())
    assert got == [("12", 2, 1, [0, 1]), ("7", 2, 0, [1]), ("7", 2, 0, [1]), ("9", 1, 0, []), ("None", 2, 0, [])]
