"""CSV in and out, with options under which any text survives the round trip."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Quotes are doubled, as other CSV readers expect; NULL is written as an empty
# field and an empty string as a quoted one; nothing is trimmed.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}

# What the reader puts for an empty field before it becomes NULL. Its default is
# the empty string, which would turn quoted empty strings into NULL as well.
EMPTY_FIELD = "\u0000"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header row; types are inferred only if no schema is given.

    Inference costs a pass over the data. ``multi_line`` allows line breaks
    inside quoted fields, at the price that a file is not split between tasks.
    """
    options = dict(CSV_OPTIONS, nullValue=EMPTY_FIELD, multiLine=str(multi_line).lower())
    if schema is None:
        return spark.read.options(**options).option("inferSchema", True).csv(path)
    return spark.read.options(**options).option("enforceSchema", False).schema(schema).csv(path)


def read_csv_by_name(spark: SparkSession, path: str, names: Sequence[str], folders: Sequence[str] = ()) -> DataFrame:
    """The named columns as text in ``raw_<name>``, wherever the header has them.

    One header holds for all files below ``path``, which Spark checks file by file.
    A missing column is an error. ``folders`` are partition folders, kept as text.
    """
    options = dict(CSV_OPTIONS, nullValue=EMPTY_FIELD, recursiveFileLookup="false")
    header = [c for c in spark.read.options(**options).csv(path).columns if c not in folders]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, *folders)])
    rows = spark.read.options(**options).option("enforceSchema", False).schema(schema).csv(path)
    return rows.select(*[F.col(f"`{n}`").alias(f"raw_{n}") for n in names], *folders)
