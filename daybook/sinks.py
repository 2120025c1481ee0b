"""Writers: CSV folders, overwriting tables, export of several tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.snapshots import Draft
from daybook.sources.files import CSV_OPTIONS


#: Bound on the size of exported files, since those with line breaks in text are not
#: split when they are read.
ROWS_PER_FILE = 1_000_000
AT_ONCE = 4


def side_by_side(jobs: Sequence[Callable]) -> list:
    """The results of independent Spark jobs, some started at a time."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return [done.result() for done in [pool.submit(job) for job in jobs]]


def write_csv(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rows_per_file: int = 0
) -> None:
    """A folder of CSV part files with a header each, replacing what was there.

    Rows are brought together per folder first, so that not every task writes to
    every folder; the hint lets Spark split a folder that holds most rows.
    ``rows_per_file`` bounds the file size where fields may hold line breaks,
    since such files are read one per task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").options(**CSV_OPTIONS).option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def overwrite_files(df: DataFrame, path: str) -> DataFrame:
    """Replace a parquet table kept at a path; returns the written table.

    The rows are written beside the old table first, so a write that fails leaves
    the old one as it was, and ``df`` may read from it. Where renaming a folder is
    not one step, as in object stores, readers should wait for the job's end.
    """
    path = path.rstrip("/")
    fresh = f"{path}-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    _put_in_place(df.sparkSession, fresh, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _put_in_place(spark: SparkSession, fresh: str, path: str) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, place, old = (jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path, f"{fresh}-old"))
    files = place.getFileSystem(conf)
    if files.exists(place) and not files.rename(place, old):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, place):
        files.rename(old, place)
        raise OSError(f"cannot put {fresh} in place of {path}")
    if files.exists(old):
        files.delete(old, True)


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Replace a catalog table below ``path``; returns the written table.

    The rows go to a fresh folder, then the catalog entry is pointed there in one step:
    a failed write leaves the old table, and ``df`` may read from it. The folder that
    was replaced stays for readers that are at work, those before it are removed. A
    table with other columns has to be dropped first.
    """
    spark = df.sparkSession
    root = (path or f"{spark.conf.get('spark.sql.warehouse.dir')}/{name}-versions").rstrip("/")
    if not spark.catalog.tableExists(name):
        fresh = f"{root}/{uuid.uuid4().hex}"
        df.write.parquet(fresh)
        spark.catalog.createTable(name, path=fresh, source="parquet")
        return spark.table(name)
    if spark.table(name).schema.simpleString() != df.schema.simpleString():
        raise ValueError(f"{name} has other columns; drop it first")
    location = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    fresh = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)
    _remove_others(spark, root, {fresh, location})
    return spark.table(name)


def _remove_others(spark: SparkSession, root: str, kept: set[str]) -> None:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(root)
    files, names = folder.getFileSystem(conf), {path.rstrip("/").rpartition("/")[2] for path in kept}
    for status in files.listStatus(folder):
        if status.getPath().getName() not in names:
            files.delete(status.getPath(), True)


def storing(out: str | Draft) -> Callable[[str, DataFrame], DataFrame]:
    """How a job keeps its tables: as folders that are replaced one by one, or as tables
    of one version that is published as a whole."""
    if isinstance(out, str):
        return lambda name, df: overwrite_files(df, f"{out}/{name}")
    return out.write


def export_tables(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> DataFrame:
    """Write every table to ``<folder>/<name>_export.csv``; one row of counts each.

    The tables are written side by side: they do not depend on each other, and a
    small one would leave a cluster idle while it is written alone.

    Rows are counted while they are written, so no table is read a second time.
    The observation sits directly below the write: there a task that is run again
    after an executor loss is counted once.
    """
    def write(name: str) -> tuple[str, int, int]:
        df, written = tables[name], Observation(f"export {name}")
        observed = df.observe(written, F.count(F.lit(1)).alias("row_count"))
        write_csv(observed, f"{folder}/{name}_export.csv", rows_per_file=ROWS_PER_FILE)
        return name, written.get["row_count"], len(df.columns)

    counts = side_by_side([lambda name=name: write(name) for name in tables])
    return spark.createDataFrame(counts, "table_name string, row_count bigint, column_count int")
