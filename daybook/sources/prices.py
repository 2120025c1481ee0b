"""Landed quote files: one folder ``asset=<name>`` per asset."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.series import missing_as_null
from daybook.schemas import QUOTES
from daybook.sources.files import read_csv_by_name

BAD_QUOTE = "_bad"


def landed_quotes(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """All assets in one read; the folder name gives the asset column.

    CSV columns are taken by their names in the header. A row whose date or number
    does not read as one, or that has no date, is an error (see ``malformed_quotes``).
    The asset type is fixed so that a numeric name is not read as a number.
    """
    return _quotes(spark, path, file_format, ["asset"])


def _quotes(spark: SparkSession, path: str, file_format: str, folders: list[str]) -> DataFrame:
    if file_format == "csv":
        rows = _checked(spark, path, folders)
        told = F.concat(F.lit("bad quote: "), F.to_json(F.struct(*rows.drop(BAD_QUOTE, *QUOTES.names).columns)))

        def refused(name: str) -> Column:
            # what a plan reads is checked, also where it does not read the date
            bad = F.col(BAD_QUOTE) if name == "Date" else _unreadable("Date") | F.col("raw_Date").isNull() | _unreadable(name)
            kind = QUOTES[name].dataType.simpleString()
            return F.when(bad, F.raise_error(told).cast(kind)).otherwise(F.col(name)).alias(name)

        return rows.select(*[refused(name) for name in QUOTES.names], *folders)
    schema = T.StructType([*QUOTES.fields, *[T.StructField(f, T.StringType()) for f in folders]])
    return spark.read.format(file_format).schema(schema).load(path)


def _checked(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Typed columns beside the raw ones (``raw_<name>``), and whether a row is bad."""
    raw = read_csv_by_name(spark, path, QUOTES.names, folders)
    typed = {f.name: F.expr(f"try_cast(`raw_{f.name}` AS {f.dataType.simpleString()})") for f in QUOTES.fields}
    rows = raw.select("*", *[c.alias(n) for n, c in typed.items()])
    bad = F.col("raw_Date").isNull() | reduce(Column.__or__, [_unreadable(n) for n in typed])
    return rows.withColumn(BAD_QUOTE, bad)


def _unreadable(name: str) -> Column:
    raw = F.col(f"raw_{name}")
    return raw.isNotNull() & ~raw.isin("nan", "NaN") & F.col(name).isNull()


def malformed_quotes(spark: SparkSession, path: str) -> DataFrame:
    """The landed CSV rows that ``landed_quotes`` refuses, as text, with their asset."""
    rows = _checked(spark, path, ["asset"])
    return rows.where(BAD_QUOTE).select("asset", *[F.col(f"raw_{n}").alias(n) for n in QUOTES.names])


def landed_prices(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """Date, close and asset of every landed quote."""
    return landed_quotes(spark, path, file_format).select(
        F.col("Date").alias("date"), missing_as_null(F.col("Close")).alias("close"), "asset"
    )


def landed_volatility(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """Date and close of a volatility index, landed like one asset without a folder."""
    return _quotes(spark, path, file_format, []).select(
        F.col("Date").alias("date"), missing_as_null(F.col("Close")).alias("vix_close")
    )
