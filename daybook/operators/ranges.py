"""Date clipping; plain column comparisons, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def between_dates(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Both ends included; a bound is the first instant of its day."""
    kind = df.schema[column].dataType
    return df.where(F.col(column).between(F.lit(first).cast(kind), F.lit(last).cast(kind)))


def history_window(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Start included, end excluded."""
    kind = df.schema[column].dataType
    return df.where((F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind)))
