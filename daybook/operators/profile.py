"""Row counts, missing values, date spans, previews and schemas as rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_column(df: DataFrame, aggregate, names: list[str]) -> DataFrame:
    """One aggregate per column in one pass, then one row per column."""
    one_row = df.agg(*[aggregate(c).alias(f"_c{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias(names[0]), F.lit(c).alias(names[1]), F.col(f"_c{i}").alias(names[2])
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return one_row.select(F.explode(pairs).alias("_row")).select("_row.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values of each column."""
    return _per_column(
        df, lambda c: F.count_if(F.col(c).isNull()), ["position", "column_name", "nulls"]
    ).select("column_name", "nulls")


def column_listing(df: DataFrame) -> DataFrame:
    """Columns of a table with type and number of values present."""
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    listing = _per_column(df, lambda c: F.count(F.col(c)), ["position", "column_name", "present"])
    return listing.select("position", "column_name", types[F.col("column_name")].alias("data_type"), "present")


def date_span(tables: Mapping[str, DataFrame], column: str = "date") -> DataFrame:
    """First and last date of each table."""
    spans = [
        df.agg(F.min(column).alias("first_date"), F.max(column).alias("last_date")).select(
            F.lit(name).alias("table_name"), "first_date", "last_date"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, spans)


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def head_and_tail(df: DataFrame, order: list[str], head: int = 10, tail: int = 5) -> DataFrame:
    """First and last rows in a given order; neither side sorts the table."""
    first = df.orderBy(*order).limit(head).withColumn("side", F.lit("head"))
    last = df.orderBy(*[F.desc(c) for c in order]).limit(tail).withColumn("side", F.lit("tail"))
    return first.unionByName(last)
