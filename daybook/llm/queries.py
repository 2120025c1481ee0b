"""Registered queries of this package, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm.decontamination import contamination
from daybook.llm.divergence import source_divergence
from daybook.llm.license_scan import license_notices
from daybook.llm.line_dedup import line_report
from daybook.llm.lm_brown import brown_scores
from daybook.llm.mixing import mixture
from daybook.llm.ngram_jaccard import ngram_jaccard
from daybook.llm.pieces import piece_spans
from daybook.llm.prefix_trie import prefix_trie
from daybook.llm.quality_rules import quality_rules
from daybook.llm.secret_scan import PATTERNS, secret_spans, span_names
from daybook.llm.sharding import sharded
from daybook.llm.tables import table
from daybook.llm.token_counts import token_counts

#: Bytes of text in a shard of the sharding query and of the pipeline.
SHARD_BYTES = 1 << 20


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules(table(spark, folder, "documents"))
    features = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{f}" for f in features])


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_jaccard(table(spark, folder, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op5_lm_brown(spark: SparkSession, folder: str) -> DataFrame:
    return brown_scores(table(spark, folder, "documents"))


def op6_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_spans(table(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("bigint").alias(f"n_{kind}") for kind, *_ in PATTERNS
    ]
    return found.select("doc_id", *counts, F.sha2(span_names(F.col("base")), 256).alias("base_sha256"), span_names(F.col("spans")).alias("spans"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixture(table(spark, folder, "documents"))
    return mix.select("row.doc_id", "size", "source_size", "target", "taken")


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_notices(table(spark, folder, "documents"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    cut = sharded(table(spark, folder, "documents").select("doc_id", "text"), limit=SHARD_BYTES)
    return cut.select("doc_id", F.col("shard.id").alias("shard"), "shard.depth", "shard.bytes", "shard.shard_bytes", "shard.shard_rows")


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    report = line_report(table(spark, folder, "documents").select("doc_id", "text"))
    return report.withColumn("removed", F.array_join(F.transform("removed", lambda i: i.cast("string")), ","))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


def op12_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    encoded = piece_spans(table(spark, folder, "documents"))
    decimals = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(decimals, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_decontamination": op4_decontamination,
    "op5_lm_brown": op5_lm_brown,
    "op6_secret_scan": op6_secret_scan,
    "op7_mixing": op7_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_sharding": op9_sharding,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_source_divergence": op13_source_divergence,
}
