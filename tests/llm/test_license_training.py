"""What operator 8 stores to learn from all paragraphs, and that it learns what Spark ML does."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from llm_tables import documents  # noqa: F401
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from daybook.llm import license_scan

TEXTS = ["a", "Licensed under the MIT license.", "", "É b\tc. x-y", "one two three four five", "--", "3.0 v" * 70, "x" * 5000, "word " * 200]


def _terms(text):
    words = "".join(c if c.isascii() and (c.isalnum() or c == ".") else " " for c in text).lower().split()
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def test_features_are_those_of_spark_ml(spark):
    hashing = HashingTF(numFeatures=license_scan.FEATURES)
    _, _, sizes, features = license_scan._grams(pa.array([None, *TEXTS]).slice(1), cut=False)
    for text, part in zip(TEXTS, np.split(features, np.cumsum(sizes)[:-1]), strict=True):
        assert part.tolist() == sorted({hashing.indexOf(t) for t in _terms(text)})


def test_long_paragraphs_are_cut_as_they_are_scored(spark):
    texts = [" ".join(f"w{i}" for i in range(n)) for n in (0, 1, 63, 64, 65, 96, 97, 128, 129, 400)]
    row, number, sizes, features = license_scan._grams(pa.array(texts), cut=True)
    cut = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", license_scan.paragraph_words(F.col("t")).alias("words"))
    pieces = cut.where(F.size("words") > 0).select("i", F.posexplode(license_scan._pieces(F.col("words"))).alias("number", "words"))
    expected = pieces.select("i", "number", F.array_join("words", " ").alias("t")).orderBy("i", "number").collect()
    assert list(zip(row, number, strict=True)) == [(r["i"], r["number"]) for r in expected]
    whole = license_scan._grams(pa.array([r["t"] for r in expected]), cut=False)
    assert (whole[2] == sizes).all() and (whole[3] == features).all()


def test_the_regression_is_that_of_spark_ml(spark, monkeypatch):
    monkeypatch.setattr(license_scan, "START_ROWS", 50)
    monkeypatch.setattr(license_scan, "TOLERANCE", 1e-8)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        label = int(i % 10 == 0) + int(i % 25 == 0)
        features = np.unique(np.concatenate((rng.integers(0, 40, rng.integers(0, 12)), [50 + label] * int(rng.random() < 0.7))).astype(int))
        rows.append((label, float([0.3, 4.0, 1.0][label]), features))
    packed = [(label, weight, f.astype("<u2").tobytes()) for label, weight, f in rows]
    schema = "label int, weight double, grams binary"
    sizes, flat = np.array([len(f) for *_, f in rows]), np.concatenate([f for *_, f in rows])
    vectors = [(float(label), weight, Vectors.sparse(license_scan.FEATURES, f.tolist(), [1.0] * len(f))) for label, weight, f in rows]
    ml = LogisticRegression(family="multinomial", weightCol="weight", regParam=license_scan.PENALTY, maxIter=100, tol=1e-10)
    ml = ml.fit(spark.createDataFrame(vectors, ["label", "weight", "features"]))
    expected = license_scan._shares(license_scan._margins(ml.coefficientMatrix.toArray(), ml.interceptVector.toArray(), sizes, flat))
    for tasks in (license_scan.TASKS, 1):  # sums at the driver, and added up in tasks before
        monkeypatch.setattr(license_scan, "TASKS", tasks)
        weights, intercepts = license_scan.LogisticRegression(3).fit(spark.createDataFrame(packed, schema))
        got = license_scan._shares(license_scan._margins(weights, intercepts, sizes, flat))
        assert np.abs(got - expected).max() < 1e-3


def test_no_text_is_stored_to_learn_and_copies_count_once(documents, monkeypatch):
    """Two bytes a feature of the trained half are kept, nothing of the other half."""
    lines = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(400)]
    kept, store = {}, license_scan.stored
    monkeypatch.setattr(license_scan, "stored", lambda df, label: kept.setdefault(label, store(df, label)))
    license_scan.train(documents(*enumerate("\n".join(lines[i::4]) for i in [0, 1, 2, 3, 3, 0])))
    assert kept["negatives"].columns == ["h", "piece", "grams", "head"] and kept["training"].columns == ["label", "weight", "grams"]
    found = kept["negatives"].agg(F.count(F.lit(1)).alias("n"), F.countDistinct("h").alias("distinct"), F.max(F.length("grams")).alias("most")).first()
    assert found["n"] == found["distinct"] and 150 < found["n"] < 250 and found["most"] <= 2 * 23
    heads = kept["negatives"].where("head is not null")
    assert license_scan.AROUND <= heads.count() < 100
    least = [r["h"] for r in kept["negatives"].orderBy("h").limit(license_scan.AROUND).collect()]
    assert {*least} <= {r["h"] for r in heads.collect()}


def test_few_passes_read_all_rows(spark, monkeypatch):
    """Between passes the driver moves by some of the rows: the same minimum in far fewer passes."""
    rng = np.random.default_rng(5)
    rows, chance = [], 0.3 / np.arange(1, 101) ** 0.7
    for i in range(4_000):
        label = i % 3 if i < 60 else 0
        features = np.flatnonzero(rng.random(100) < chance)
        rows.append((label, 2.0 if label else 0.1, np.unique(np.append(features, 100 + label)) if label else features))
    packed = spark.createDataFrame([(label, weight, f.astype("<u2").tobytes()) for label, weight, f in rows], "label int, weight double, grams binary").cache()
    sizes, flat = np.array([len(f) for *_, f in rows]), np.concatenate([f for *_, f in rows])
    passes, sums = [], license_scan._sums
    monkeypatch.setattr(license_scan, "_sums", lambda frame, vector: [passes.append(frame.count()), sums(frame, vector)][1])
    monkeypatch.setattr(license_scan, "START_ROWS", 2_000)
    near = license_scan._shares(license_scan._margins(*license_scan.LogisticRegression(3).fit(packed), sizes, flat))
    few = len(passes)
    monkeypatch.setattr(license_scan, "START_ROWS", 4_000)  # all rows: the driver finds the minimum itself
    monkeypatch.setattr(license_scan, "TOLERANCE", 1e-9)
    least = license_scan._shares(license_scan._margins(*license_scan.LogisticRegression(3).fit(packed), sizes, flat))
    assert set(passes) == {4_000} and few <= 8
    assert np.abs(near - least).max() < 1e-3


def test_the_plain_search_misses_no_cue(spark):
    cues = ["LICENSED", "licence", "(C) CopyRight", "SPDX", "all Rights Reserved", "Permission is hereby", "redistributION", "Free Software", "PUBLIC domain",
            "Creative COMMONS", "CC-BY", "cc by", "GPL", "x GPLv3", "bsd"]
    texts = [f"{before}\n{cue} {after}" for cue in cues for before, after in [("", ""), ("\u0130stanbul \u0307", "\u03a3\u212a \u00df"), ("I\u0307", "I\u0307")]]
    df = spark.createDataFrame([(t,) for t in [*texts, "other text", "", None]], "text string")
    found = df.select("text", F.coalesce(F.col("text").rlike(license_scan.CUES), F.lit(False)), license_scan._may_have_cue(F.col("text"))).collect()
    assert sum(r[1] for r in found) == len(texts)
    assert [r[1] for r in found] == [r[2] for r in found]


def test_paragraphs_with_and_without_cue_in_one_text(documents):
    """A cue in a text keeps only its own paragraph from being learned."""
    plain, cued = [" ".join(f"p{i}x{j}" for j in range(12)) for i in range(40)], [" ".join(f"license q{i}x{j}" for j in range(12)) for i in range(40)]
    df = documents(*enumerate("\n".join(pair) for pair in zip(plain, cued, strict=True)))
    found = license_scan.license_notices(df).collect()
    assert {(r["doc_id"], r["paragraph"]) for r in found} == {(i, 1) for i in range(40)}


def _model(threshold, **weights):
    """A model that knows single words: the family's weight of each."""
    labels = [license_scan.NONE, "MIT", "GPL-3.0"]
    by_class = np.zeros((3, license_scan.FEATURES))
    for word, (family, weight) in weights.items():
        _, _, _, [feature] = license_scan._grams(pa.array([word]), cut=False)
        by_class[labels.index(family), feature] = weight
    return license_scan.LicenseModel(by_class, np.array([3.0, 0.0, 0.0]), labels, threshold)


def test_every_paragraph_is_scored_and_every_family_of_it_given(documents):
    """Also those without a cue word; a line has a row for each family, and for unknown but beside the same family."""
    model = _model(0.9, alpha=("MIT", 9.0), beta=("GPL-3.0", 9.0), gamma=("GPL-3.0", 4.0), delta=("MIT", 4.0))
    f = [f"w{i}" for i in range(300)]
    texts = [
        "x y\nalpha here\n\nz", " ".join([*f[:10], "alpha", *f, "beta", *f[:70]]), "gamma", "a license\nother", None, "",
        " ".join([*f[:20], "beta", *f[:30], "gamma", *f[:30]]), " ".join([*f[:5], "beta", *f[:150], "gamma", *f[:20]]), " ".join([*f, "license", *f]),
        "license alpha", "license gamma", " ".join([*f[:20], "beta", *f[:30], "delta", *f[:30]]),
    ]
    found = license_scan.license_notices(documents(*enumerate(texts), (None, "alpha"), (2, "gamma")), model=model).collect()
    assert sorted([(-1 if r["doc_id"] is None else r["doc_id"], r["paragraph"], r["family"]) for r in found]) == [
        (-1, 0, "MIT"), (0, 1, "MIT"), (1, 0, "GPL-3.0"), (1, 0, "MIT"), (2, 0, "unknown"), (2, 0, "unknown"), (3, 0, "none"),
        (6, 0, "GPL-3.0"), (7, 0, "GPL-3.0"), (7, 0, "unknown"), (8, 0, "none"), (9, 0, "MIT"), (10, 0, "unknown"), (11, 0, "GPL-3.0"), (11, 0, "unknown"),
    ]


def test_pieces_of_all_paragraphs_with_their_words(spark):
    texts = [None, *TEXTS, "--\u00e9", " ".join(f"T{i}, \u00fcb" for i in range(150))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, content string")
    cut = df.select("i", F.posexplode(license_scan._pieces(license_scan.paragraph_words(F.col("content")))).alias("piece", "words")).where(F.size("words") > 0)
    expected = {(r["i"], r["piece"]): " ".join(r["words"]) for r in cut.collect()}
    scored = _model(0.5, mit=("MIT", 9.0)).likeliest(df.select("i", (F.col("i") >= 0).alias("cued"), "content")).collect()
    assert {(r["i"], r["piece"]): r["words"] for r in scored} == expected and len(scored) == len(expected)
    assert {r["i"] for r in scored if r["family"] == "MIT"} == {i for i, t in enumerate(texts) if t and "MIT" in t}


def test_other_text_is_none_where_no_paragraph_is_learned(documents):
    """The only paragraph has a cue: what lies around its notice is no notice of another family."""
    filler = " ".join(f"wort{i}" for i in range(200))
    df = documents((1, f"{filler} This work is licensed under the GNU General Public License, version 3. {filler}"))
    scored = license_scan.train(df).likeliest(df.select("doc_id", F.lit(True).alias("cued"), F.col("text").alias("content"))).collect()
    assert [r["family"] for r in sorted(scored, key=lambda r: r["piece"])] == [*["none"] * 5, "GPL-3.0", "GPL-3.0", *["none"] * 5]
