"""Operators that look at one text at a time."""

from __future__ import annotations

import random
import re

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from llm_tables import documents, rows  # noqa: F401

from daybook.llm import arrowtext, license_scan, secret_scan, token_counts
from daybook.llm.quality_rules import FEATURES, fit, keep_good, quality_rules

AWKWARD = ["", None, " ", "\n", "\n\n x \n", "a", "é b\tc\x0bd", "x" * 5000, "A b\x1cc d", "価格 | $1 #2"]


def test_words_and_hashes_equal_plain_splitting():
    column = pa.array([*AWKWARD, "a A a", *[" ".join(["w%d" % i for i in range(3000)])]])
    hashes, at = arrowtext.words_of(column.slice(1))
    texts = column.to_pylist()[1:]
    assert [int(n) for n in np.diff(at)] == [len(brute.words(t)) for t in texts]
    flat = [w for t in texts for w in brute.words(t)]
    assert len(set(flat)) == len(set(hashes.tolist()))
    assert all(h == hashes[flat.index(w)] for h, w in zip(hashes, flat, strict=True))


def test_long_texts_are_hashed_in_windows(monkeypatch):
    text = pa.array([" ".join("word%d" % (i % 50) for i in range(4000)) + " " + "y" * 3000])
    whole = arrowtext.words_of(text)[0]
    monkeypatch.setattr(arrowtext, "WINDOW", 64)
    assert (arrowtext.words_of(text)[0] == whole).all()


def test_quality_features_equal_brute_force(spark, documents):
    rng = random.Random(3)
    texts = AWKWARD + [" ".join(rng.choice("abcde") * rng.randint(1, 3) for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts += ["same line here\n" * 3 + "x # *", "one two three four five six seven eight nine " * 4]
    df = documents(*enumerate(texts), extra="quality kept n_words")
    for r in quality_rules(df, carry=df.columns, into="quality").collect():
        got = r["quality_"]
        n, chars, symbols, dup, repeat = brute.base_quality(texts[r["doc_id"]])
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"], got["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert got["base_failed"] == (n < 20 or 100 * repeat > 30 * n)
        assert r["quality"] == r["kept"] == "kept"


def test_votes_are_weighed_by_estimated_accuracy():
    rng = np.random.default_rng(5)
    good = rng.random(4000) < 0.8
    accuracy = [0.95, 0.9, 0.9, 0.55]
    votes = np.stack([np.where(rng.random(4000) < a, good, ~good) * 2 - 1 for a in accuracy], axis=1)
    pattern, count = np.unique(votes, axis=0, return_counts=True)
    model = fit(pattern, count.astype(float))
    reach = [w[2] - w[0] for w in model.weights]
    assert min(reach[:3]) > 2 > abs(reach[3])


def test_clean_text_stays_and_junk_goes(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = keep_good(docs)
    assert kept.columns == docs.columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    judged = quality_rules(docs, into="found").join(labels, "doc_id").selectExpr("found.kept", "found.base_failed", "quality")
    for kept_row, failed, label in rows(judged):
        assert kept_row == (label == 1 and not failed)


def test_empty_table_has_no_quality_rows(documents, spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert quality_rules(empty).collect() == [] and keep_good(empty).collect() == []
    assert len(FEATURES) == len(set(FEATURES))


# Secrets


def _spans(documents, *texts):
    found = secret_scan.secret_spans(documents(*enumerate(texts), extra="spans base"))
    return {r["doc_id"]: ([tuple(s) for s in r["base"]], [tuple(s) for s in r["spans"]]) for r in found.collect()}


def test_fixed_patterns(documents):
    texts = [
        'é password = "hunter22" x', "SECRET:abc TOKEN=abcdef", "secret:token\"=\"abcdef", "AKIA" + "A" * 16 + " AKIASHORT", "f" * 24 + " " + "e" * 23,
        None, "", 'api_key: deadbeefdeadbeefdeadbeef', "api-key=abcdef apikey=abcdef",
    ]
    found = _spans(documents, *texts)
    kinds = {i: [(s[3], s[0], s[2]) for s in base] for i, (base, _) in found.items()}
    assert kinds[0] == [("assign", 2, 22)]
    assert kinds[1] == [("assign", 11, 23)]
    assert kinds[2] == []
    assert kinds[3] == [("access", 0, 20)]
    assert kinds[4] == [("hex", 0, 24)]
    assert kinds[5] == kinds[6] == []
    assert kinds[7] == [("assign", 0, 33), ("hex", 9, 33)]
    assert kinds[8] == [("assign", 15, 28)]


def _plain_base(text):
    assign = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    found = []
    for rank, (pattern, least) in enumerate([(assign, 6), (r"(AKIA[A-Z0-9]+)", 20), (r"([0-9a-f]+)", 24)]):
        found += [(m.start(), rank, m.end(), secret_scan.PATTERNS[rank][0]) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return sorted(found)


def _plain_spans(text):
    """All spans by looking at each window anew."""
    base = _plain_base(text)
    left = list(text)
    for start, _, stop, _ in base:
        left[start:stop] = " " * (stop - start)
    stretches = []
    for number, (kind, _, drawn, characters) in enumerate(secret_scan.CLASSES):
        bits = np.log2(20) - secret_scan.most_repetition(drawn) / 20e6
        for m in re.finditer(f"[{characters}]{{20,}}", "".join(left)):
            s = m[0]
            name = re.fullmatch("[0-9]{0,4}", re.sub(secret_scan.NAME_PARTS, "", s))
            if name or any(re.search(p, s) for p in secret_scan.ALLOWED):
                continue
            last = None
            for j in range(len(s) - 19):
                if brute.entropy(s[j : j + 20]) >= bits - 1e-9:
                    if last is None or j > last[2] - m.start():
                        last = [m.start() + j, 3 + number, 0, kind]
                        stretches.append(last)
                    last[2] = m.start() + j + 20
    out, at = [], 0
    for start, rank, stop, kind in sorted(map(tuple, stretches)):
        if stop > max(start, at):
            out.append((max(start, at), rank, stop, kind))
        at = max(at, stop)
    return base, sorted(base + out)


def test_spans_equal_brute_force(documents):
    rng = random.Random(11)
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    drawn = ["0123456789abcdef", "0123456789ABCDEF", lower + digits, upper + digits, lower + upper + digits, lower + upper + digits + "+/", "ab1"]

    def part():
        kind = rng.randrange(10)
        if kind == 0:
            return rng.choice(["password", "Secret", "api_key", "TOKEN", "token"]) + rng.choice([":", " = ", "=\"", "::"])
        if kind == 1:
            return "AKIA" + "".join(rng.choice(upper + digits) for _ in range(rng.choice([3, 15, 16, 30])))
        if kind == 2:
            return rng.choice([" ", "\n", "-", "_", "é", "internationalization", "some-well-known-name", "123e4567-e89b-12d3-a456-426614174000"])
        return "".join(rng.choice(rng.choice(drawn) if kind == 3 else drawn[kind % 7]) for _ in range(rng.randint(1, 60)))

    texts = ["".join(part() + rng.choice(["", " "]) for _ in range(rng.randint(1, 8))) for _ in range(150)]
    texts += ["token:api: abcdefgh " * 300, "token=abcdef " * 700 + "f" * 30, "x y " * 3000]
    found = _spans(documents, *texts)
    assert {3, 4, 5, 6, 7} <= {s[1] for _, spans in found.values() for s in spans}
    for i, text in enumerate(texts):
        assert found[i] == _plain_spans(text), text


@pytest.mark.parametrize("drawn", [16, 36, 64])
def test_thresholds_miss_few_random_windows(drawn):
    windows = np.random.default_rng(1).integers(0, drawn, (20_000, 20))
    counts = np.stack([(windows == c).sum(axis=1) for c in range(drawn)], axis=1)
    missed = (np.array(secret_scan._TERMS)[counts].sum(axis=1) > secret_scan.most_repetition(drawn)).mean()
    assert missed <= secret_scan.MISS + 0.01


def test_a_long_run_and_odd_rows_are_scanned_whole(spark):
    rng = random.Random(12)
    key = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(20_000))
    df = spark.createDataFrame([(None, key), (1, ""), (1, ""), (2, None)], "doc_id bigint, text string")
    found = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in secret_scan.secret_spans(df).collect()}
    assert found[None] == _plain_spans(key)[1] and found[1] == found[2] == []
    assert secret_scan.secret_spans(df).count() == 4
    assert secret_scan.secret_spans(df.limit(0)).collect() == []


def test_allowed_strings_are_no_secrets(documents):
    allowed = ["averylongwordwithoutanydigits", "123e4567-e89b-12d3-a456-426614174000", "12345678901234567890123", "abcdefghijklmnop0123456789QRSTuv"]
    assert all(spans == [] for _, spans in _spans(documents, *allowed).values())


# Tokens


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_add_up_to_whole_documents(documents, rule):
    texts = [t for t in AWKWARD] + ["one\n\n\ntwo  \n three", "ends\n", "日本語\nテキスト\n\nx"]
    encoding, length = token_counts.encoder(token_counts.read_ranks(token_counts.VOCABULARY), token_counts.PIECES)
    out = token_counts.token_counts(documents(*enumerate(texts), extra="start stop"), rule=rule).collect()
    for i, text in enumerate(texts):
        own = sorted((r for r in out if r["doc_id"] == i), key=lambda r: r["section"])
        tokens = encoding.encode_ordinary(text or "")
        assert sum(r["n_tokens"] for r in own) == len(tokens)
        assert encoding.decode(tokens) == (text or "") and int(length[tokens].sum()) == len((text or "").encode())
        assert "".join((text or "")[r["start"] : r["stop"]] for r in own) == (text or "")
        assert [r["section"] for r in own] == list(range(len(own)))


def test_long_white_space_is_cut_where_the_pattern_cuts(monkeypatch):
    encoding, _ = token_counts.encoder(token_counts.read_ranks(token_counts.VOCABULARY), token_counts.PIECES)
    monkeypatch.setattr(token_counts, "_RUN", re.compile(token_counts._RUN.pattern.replace("{10000,}", "{3,}")))
    rng = random.Random(4)
    spaces = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"
    for _ in range(3000):
        text = "".join(rng.choice(["   ", "\n\n\n", " ", rng.choice(spaces), "ab", "7", ".", "'s", "\x1c", "\u200b", "é"]) for _ in range(12))
        assert token_counts.encode(encoding, text) == encoding.encode_ordinary(text)


def test_a_text_of_two_million_spaces_is_counted(documents):
    texts = ["a" + " " * 2_000_000 + "b", "\n" * 1_000_001, "x " * 3 + "y" * 2_000_000]
    out = token_counts.token_counts(documents(*enumerate(texts))).groupBy("doc_id").agg({"n_tokens": "sum", "stop": "max"}).collect()
    encoding, length = token_counts.encoder(token_counts.read_ranks(token_counts.VOCABULARY), token_counts.PIECES)
    for r in out:
        tokens = token_counts.encode(encoding, texts[r["doc_id"]])
        assert encoding.decode(tokens) == texts[r["doc_id"]] and r["sum(n_tokens)"] == len(tokens) and r["max(stop)"] == len(texts[r["doc_id"]])
    assert len(out) == 3


def test_crossing_tokens_follow_the_rule():
    stops, bounds = np.array([2, 7, 9]), np.array([0, 3, 4, 9])
    first, crossing = token_counts.attribute(stops, bounds, "first")
    assert first.tolist() == [2, 0, 1] and crossing.tolist() == [1, 0, 0]
    most, _ = token_counts.attribute(stops, bounds, "most")
    assert most.tolist() == [1, 0, 2]


# Licences


def test_notices_of_each_family_and_other_text(spark, documents):
    other = "Thentien anonly onorresh erth inat erorea eror that shth ortint on that shingen anines thinwh tiouwh of the tint"
    held_out = {
        "MIT": "The code is released under the MIT license", "Apache-2.0": "It is licensed under the Apache License, Version 2.0 only",
        "GPL-3.0": "licensed under the GNU General Public License version 3", "CC-BY-NC": "Text licensed under CC BY-NC 4.0",
    }
    texts = [f"{other}\n{notice}\n{other} {i}" for i, notice in enumerate(held_out.values())]
    texts += [f"{other} license {other}", None, "", other]
    df = documents(*enumerate(texts), extra="family paragraph")
    found = {r["doc_id"]: r for r in license_scan.license_notices(df).collect()}
    for i, family in enumerate(held_out):
        assert (found[i]["family"], found[i]["confirmed"], found[i]["paragraph"]) == (family, True, 1)
    assert not found[4]["confirmed"] and set(found) == {0, 1, 2, 3, 4}


def test_a_notice_inside_a_long_paragraph_is_found(documents):
    filler = " ".join(f"wort{i}" for i in range(200))
    df = documents((1, f"{filler} This work is licensed under the GNU General Public License, version 3. {filler}"))
    found = license_scan.license_notices(df).collect()
    assert [(r["family"], r["confirmed"]) for r in found] == [("GPL-3.0", True)]


def test_every_paragraph_without_cue_is_learned_and_calibrated_with(spark, documents, monkeypatch):
    """Of 5,200 paragraphs, long ones in pieces, none is left out of the fit or the level."""
    lines = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(5_195)] + [" ".join(f"v{i}x{j}" for j in range(400)) for i in range(5)]
    df = documents(*enumerate("\n".join(lines[i::20]) for i in range(20)))
    seen = {}
    fit, level = license_scan.LogisticRegression.fit, license_scan._level
    monkeypatch.setattr(license_scan.LogisticRegression, "fit", lambda self, rows: [seen.update(fit=rows.where("label = 0").count()), fit(self, rows)][1])
    monkeypatch.setattr(license_scan, "_level", lambda shares: [seen.update(level=shares.count()), level(shares)][1])
    license_scan.train(df)
    assert seen["fit"] + seen["level"] == 5_195 + 5 * 12 and min(seen.values()) > 2_000


def test_the_level_leaves_the_false_share_above(spark):
    shares = spark.range(10_000).select((F.col("id") / 10_000).alias("share"))
    assert license_scan._level(shares) == 0.999 and license_scan._level(shares.where("id < 100")) == 0.5
    assert license_scan._level(shares.where("id < 0")) == 0.5
