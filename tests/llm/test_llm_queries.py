"""Registered queries against their SQL, and the contract of all."""

from __future__ import annotations

import pytest
from oracle_check import connect, differences

from daybook.llm.oracle import ORACLE
from daybook.llm.queries import QUERIES

CONTRACT = {
    "op1_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op3_ngram_jaccard": "doc_id n_shingles component_id",
    "op4_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated",
    "op5_lm_brown": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op6_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op7_mixing": "doc_id size source_size target taken",
    "op12_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
}


def test_one_query_for_each_number():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, name):
    assert differences(spark, connect(small), QUERIES[name], ORACLE[name], small) == []


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_columns_and_rows(spark, small, name):
    out = QUERIES[name](spark, small)
    assert set(CONTRACT[name].split()) <= set(out.columns)
    types = dict(out.dtypes)
    assert all(types[c] == "bigint" for c in CONTRACT[name].split() if c.startswith("n_") or c in ("doc_id", "size", "taken"))
    assert out.count() == spark.read.parquet(f"{small}/documents.parquet").count()
