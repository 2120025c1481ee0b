"""Session construction and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "daybook") -> SparkSession:
    """Session for tests and the local bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


@cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="daybook-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-path of the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder, since
    executors on other machines could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = _local_folder()
    application = spark.sparkContext.applicationId
    return f"{base.rstrip('/')}/daybook/{application}/{label}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> None:
    """Remove what this application wrote below the shared folder.

    For the end of an application on a cluster: results that were not written
    elsewhere are read from there until then.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/daybook/{spark.sparkContext.applicationId}")
        path.getFileSystem(conf).delete(path, True)
