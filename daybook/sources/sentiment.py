"""Sentiment index payloads: JSON documents with a ``data`` array."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.series import utc_time
from daybook.schemas import SENTIMENT_PAYLOAD


def landed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file, whole text in ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def _required(name: str, kind: str) -> Column:
    value = F.expr(f"try_cast(_entry.{name} AS {kind})")
    told = F.concat(F.lit(f"sentiment element without {name}: "), F.to_json("_entry"))
    return F.coalesce(value, F.raise_error(told).cast(kind))


def sentiment_days(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """One row per element of ``data``: time, index value, its class.

    A payload that is not JSON or has no ``data``, and an element without a numeric
    time or value, is an error: its days would be missing without a trace otherwise.
    """
    entries = F.from_json(F.col(column), SENTIMENT_PAYLOAD, {"mode": "FAILFAST"})["data"]
    present = F.coalesce(entries, F.raise_error(F.lit("sentiment payload without data")))
    return payloads.select(F.explode(present).alias("_entry")).select(*required())


def required() -> list[Column]:
    """The columns of an element in ``_entry``; one that is missing is an error."""
    return [
        utc_time(_required("timestamp", "bigint")).alias("date"),
        _required("value", "int").alias("fng_value"),
        F.col("_entry.value_classification").alias("fng_classification"),
    ]
