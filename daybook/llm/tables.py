"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import shared_path

#: Characters that separate words, in Java's and DuckDB's pattern syntax.
SPACES = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """The frame written to the shared folder and read again: lineage is cut there,
    and the rows outlive the executors that computed them. Each value of the columns
    ``by`` has a folder of its own, so that filters on them read nothing else."""
    path = shared_path(df.sparkSession, label)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Paths that ``stored`` has written, for each open ``noted``.
_scopes: list[list[str]] = []


@contextmanager
def noted() -> Iterator[list[str]]:
    """Collects the paths that ``stored`` writes meanwhile."""
    _scopes.append([])
    try:
        yield _scopes[-1]
    finally:
        made = _scopes.pop()
        if _scopes:
            _scopes[-1].extend(made)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Removes stored tables that nothing reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    paths.clear()


def only(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that ``build`` gives, stored; what it stored on the way is removed."""
    with noted() as made:
        out = stored(build(), label)
        result = made.pop()
        removed(spark, made)
        made.append(result)
    return out


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str = SPACES) -> Column:
    """Words of a text in order; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), separators), lambda w: w != "")


def member_filter(df: DataFrame, column: str, bits: int = 22) -> np.ndarray:
    """A Bloom filter of one hash over a long column, as 2^bits booleans.

    The set bits are collected: 2^bits at most, whatever the size of the frame. A
    full filter only passes more rows on to the exact join that must follow.
    """
    slots = df.select((F.xxhash64(column).bitwiseAND((1 << bits) - 1)).cast("int").alias("slot")).distinct()
    out = np.zeros(1 << bits, dtype=bool)
    found = slots.toArrow().column("slot").to_numpy()
    out[found] = True
    return out


def commonest(counts: DataFrame, most: int) -> DataFrame:
    """The rows of ``counts(.., n)`` of the greatest ``n``, ``most`` at most.

    The least ``n`` comes from a histogram of eight classes per power of two (some
    500 rows), so that no task has to merge the leading rows of all others. Rows of
    one class come all or none.
    """
    level = F.floor(F.log2(F.col("n").cast("double")) * 8).cast("int")
    found = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    least, total = None, 0
    for row in sorted(found, key=lambda r: -r["level"]):
        total += row["rows"]
        if total > most:
            break
        least = row["level"]
    return counts.where(level >= least if least is not None else F.lit(False))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that names beside it cannot clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def filter_slot(column: str, bits: int = 22) -> Column:
    return F.xxhash64(column).bitwiseAND((1 << bits) - 1).cast("int")
