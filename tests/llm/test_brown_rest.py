"""Words beyond the clustered ones in operator 5."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from daybook.llm import lm_brown


@pytest.fixture
def corpus(spark):
    def build(texts):
        return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    return build


def _scored(df):
    return lm_brown.brown_scores(df).toPandas().set_index("doc_id").sort_index()


def test_rare_words_join_classes_by_their_contexts(corpus, monkeypatch):
    """Words of one length that few texts have are told apart by what is beside them."""
    monkeypatch.setattr(lm_brown, "CLUSTERED", 126)
    rng = random.Random(3)
    nouns, verbs = [f"n{i:03}" for i in range(100)], [f"v{i:03}" for i in range(100)]
    often = [5] * 60 + [1] * 40
    texts = [f"the {rng.choices(nouns, often)[0]} and may {rng.choices(verbs, often)[0]} so on" for _ in range(1500)]
    right, wrong = "the n099 and may v099 so on", "the v099 and may n099 so on"
    found = _scored(corpus([*texts, right, wrong]))
    assert abs(found.base_score[1500] - found.base_score[1501]) < 1e-9
    assert found.score[1500] > found.score[1501] + 1


def test_what_is_joined_does_not_change_a_score(corpus, monkeypatch):
    monkeypatch.setattr(lm_brown, "CLUSTERED", 10)
    rng = random.Random(4)
    words = [f"w{i}" * rng.randint(1, 6) for i in range(120)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += texts[:40] + [None, "", "unseen0 unseen1 w1 unseen2", "w3 w3 w3 w3"]
    whole = _scored(corpus(texts))
    monkeypatch.setattr(lm_brown, "LOOKUP", 12)
    few = _scored(corpus(texts))
    for column in ("n_tokens", "n_known", "train_tokens"):
        assert (whole[column] == few[column]).all()
    assert np.allclose(whole.base_score, few.base_score) and np.allclose(whole.score, few.score)


def test_words_of_one_frequency_are_clustered(corpus, monkeypatch):
    """More equally frequent words than the lookup has: it stays empty, the classes do not."""
    monkeypatch.setattr(lm_brown, "LOOKUP", 50)
    monkeypatch.setattr(lm_brown, "CLUSTERED", 40)
    texts = [f"a{i} b{i}" for i in range(100)]
    model, rest = lm_brown.learn(corpus(texts).select("text"))
    assert len(model.lookup) == 41 and rest.count() == 160


def test_the_class_joined_raises_the_likelihood_most():
    rng = np.random.default_rng(6)
    size = lm_brown.ALL_CLASSES
    matrix = rng.integers(0, 50, (size, size)).astype(float)
    row, code, n = [], [], []
    expected = []
    for word in range(20):
        sides = rng.integers(0, 2, (2, size)) * rng.integers(1, 40, (2, size))
        sides[:, 0] += 1
        sides[1, 1] += max(0, sides[0].sum() - sides[1].sum())
        sides[0, 1] += max(0, sides[1].sum() - sides[0].sum())
        gains = []
        for c in range(lm_brown.CLASSES):
            m = matrix.copy()
            m[c] += sides[0]
            gains.append(lm_brown._xlogx(m).sum())
            m = matrix.copy()
            m[:, c] += sides[1]
            gains[-1] += lm_brown._xlogx(m).sum()
            for total in (matrix.sum(1), matrix.sum(0)):
                gains[-1] -= float(lm_brown._xlogx(total[c] + sides[0].sum()) - lm_brown._xlogx(total[c]))
        expected.append(int(np.argmax(gains)))
        for i in np.flatnonzero(sides.ravel()):
            row.append(word), code.append(i), n.append(sides.ravel()[i])
    c, total = lm_brown._joined_classes(matrix, np.array(row), np.array(code), np.array(n))
    assert c.tolist() == expected and (total > 0).all()


def test_a_context_is_one_row_and_gives_both_sides():
    """Tokens between the same two classes are one row, whose sides are counted on their own."""
    size, rng = lm_brown.ALL_CLASSES, np.random.default_rng(7)
    row = np.sort(rng.integers(0, 5, 400))
    row = np.unique(row, return_inverse=True)[1]
    before, after, n = rng.integers(0, 6, 400), rng.integers(0, 6, 400), rng.integers(1, 9, 400)
    expected = {}
    for r, b, a, times in zip(row, before, after, n, strict=True):
        for code in (int(a), size + int(b)):
            expected[int(r), code] = expected.get((int(r), code), 0) + int(times)
    got = lm_brown._sides(row, (3 * size + before) * size + after, n)
    assert [(int(r), int(c), int(k)) for r, c, k in zip(*got, strict=True)] == [(*key, expected[key]) for key in sorted(expected)]

    class Shared:
        value = (np.array([], dtype=np.int64), np.arange(lm_brown.CLASSES, lm_brown.ALL_CLASSES))

    text = pa.RecordBatch.from_arrays([pa.array(["aa bbb aa bbb aa", "aa bbb"])], names=["text"])
    found = [r for batch in lm_brown._contexts(Shared)(iter([text])) for r in batch.to_pylist()]
    assert sum(r["n"] for r in found) == 7 and len(found) == 5
