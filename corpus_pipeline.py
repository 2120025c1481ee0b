"""The training-data pipeline over ``documents``: quality, near copies, benchmark
passages, source mix, shards.

Each stage reads all rows the one before it kept and its decisions take effect. All
but the last return the columns of ``documents``, whatever these are; the last adds
the shard of each row. A missing ``benchmark`` is an error, an empty one is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm.decontamination import without_benchmark
from daybook.llm.mixing import mixed_documents
from daybook.llm.ngram_jaccard import one_per_component
from daybook.llm.quality_rules import keep_good
from daybook.llm.sharding import sharded
from daybook.llm.tables import stored, table

SHARD_BYTES = 1 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules keep."""
    return keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id."""
    return one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark window occurs."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with the shard they go to."""
    return sharded(docs, limit=SHARD_BYTES)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

#: The estimates of the quality rules are iterated and have no SQL; the tests compare
#: every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage {name}".replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLE = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
