"""The pipeline's stages against brute force, on the smallest table and on odd rows."""

from __future__ import annotations

from collections import Counter

import brute
import pytest
from llm_tables import documents  # noqa: F401

import corpus_pipeline as pipeline
from daybook.llm.decontamination import contamination
from daybook.llm.tables import table


def test_stages_are_the_dealt_ones():
    names = [name for name, _ in pipeline.STAGES]
    assert names == [
        "quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = table(spark, small, "documents"), []
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, small)
        out.append(docs.toPandas())
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    return out


def test_each_stage_takes_effect(spark, small, stages):
    docs = table(spark, small, "documents").toPandas()
    quality, unique, clean, mix, shards = stages
    labels = table(spark, small, "labels").toPandas().set_index("doc_id").quality
    for row in docs.itertuples():
        n, *_, repeat = brute.base_quality(row.text)
        failed = n < 20 or 100 * repeat > 30 * n
        if row.doc_id in labels.index:
            assert (row.doc_id in set(quality.doc_id)) == (labels[row.doc_id] == 1 and not failed)
    found = brute.components(list(zip(quality.doc_id, quality.text, strict=True)))
    assert sorted(unique.doc_id) == sorted(set(found.values()))
    bad = contamination(spark.createDataFrame(unique), table(spark, small, "benchmark")).where("contaminated").toPandas()
    assert sorted(clean.doc_id) == sorted(set(unique.doc_id) - set(bad.doc_id)) and len(bad)
    expected = brute.mixed(list(zip(clean.doc_id, clean.text, clean.source, strict=True)))
    sizes = {i: len(brute.words(t)) for i, t in zip(clean.doc_id, clean.text, strict=True)}
    taken = Counter()
    for i, source in zip(mix.doc_id, mix.source, strict=True):
        taken[source] += sizes[i]
    largest = {s: max(sizes[i] for i, x in zip(clean.doc_id, clean.source, strict=True) if x == s) for s in expected}
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1 for s, (_, t) in expected.items())
    assert max(Counter(mix.doc_id).values()) <= 3
    assert sorted(shards.doc_id) == sorted(mix.doc_id)
    assert max(s["shard_bytes"] for s in shards["shard"]) <= pipeline.SHARD_BYTES
    for frame in stages[:-1]:
        assert list(frame.columns) == list(docs.columns)


def test_odd_rows_go_through_every_stage(spark, small, documents):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text + " end"), (None, text.replace("word", "other")), (3, None), (4, ""), (5, " "), (6, "x y")]
    for given in (rows, []):
        docs = documents(*given, extra="shard key token quality row block size text_key")
        columns = docs.columns
        for number, (_, stage) in enumerate(pipeline.STAGES):
            docs = stage(spark, docs, small)
            if number < 4:
                assert docs.columns == columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        if given:
            assert {r["doc_id"] for r in docs.collect()} == {1, None}
        else:
            assert docs.count() == 0


def test_run_is_registered_and_repeats(spark, small):
    import __spark_entry__

    run = __spark_entry__.queries()["pipeline"]
    first, second = (sorted(map(str, run(spark, small).collect())) for _ in range(2))
    assert first == second and first
