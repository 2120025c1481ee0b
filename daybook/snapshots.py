"""Tables that are replaced together: versions, and one pointer to the current one.

A draft writes its tables into a folder of its own. Publishing puts one small file in
place, which names the folder of every table, so all tables change in one step or none
does; a job that fails before leaves readers where they were. A reader resolves the
pointer once and keeps to the tables it named, whatever is published meanwhile.

    snapshots = Snapshots(spark, "s3a://tables/daybook")
    with snapshots.draft() as draft:            # published at the end, if nothing failed
        prices = draft.write("prices", df)      # read again from the written table
    tables = snapshots.tables()
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_POINTERS, _VERSIONS = "_pointers", "_versions"


class Snapshots:
    """The versions of a set of tables below a folder of any file system Spark knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._files = self._path("").getFileSystem(self._conf)

    def _path(self, below: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def versions(self) -> list[int]:
        """The numbers of what has been published and not expired, oldest first."""
        folder = self._path(_POINTERS)
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name) for name in names if name.isdigit())

    def _named(self, version: int) -> dict[str, str]:
        """Table names and their folders below the root."""
        stream = self._files.open(self._path(f"{_POINTERS}/{version:012d}"))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return dict(line.split("\t") for line in text.splitlines())

    def tables(self, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of a version, of the current one if none is named."""
        found = self.versions()
        if not found or (version is not None and version not in found):
            raise LookupError(f"nothing published as {version or 'a first version'} in {self.root}")
        named = self._named(found[-1] if version is None else version)
        return {name: self.spark.read.parquet(f"{self.root}/{folder}") for name, folder in named.items()}

    def draft(self) -> Draft:
        """A next version; tables that it does not write stay as they are."""
        return Draft(self)

    def _publish(self, after: int, named: dict[str, str]) -> int:
        version = after + 1
        fresh, place = self._path(f"{_POINTERS}/fresh-{uuid.uuid4().hex}"), self._path(f"{_POINTERS}/{version:012d}")
        stream = self._files.create(fresh, True)
        try:
            stream.write(bytearray("".join(f"{n}\t{folder}\n" for n, folder in named.items()).encode()))
        finally:
            stream.close()
        # a name that is taken already belongs to a job that was faster
        if self._files.exists(place) or not self._files.rename(fresh, place):
            self._files.delete(fresh, False)
            raise FileExistsError(f"version {version} of {self.root} was published by another job")
        return version

    def expire(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` versions, and the tables only they name.

        Readers of the version before the current one may still be at work: keep two.
        """
        found = self.versions()
        old, kept = found[:-keep], found[-keep:]
        used = {folder for version in kept for folder in self._named(version).values()}
        for version in old:
            for folder in set(self._named(version).values()) - used:
                self._files.delete(self._path(folder), True)
            self._files.delete(self._path(f"{_POINTERS}/{version:012d}"), False)


class Draft:
    """A version that is being written."""

    def __init__(self, snapshots: Snapshots) -> None:
        self.snapshots = snapshots
        self.folder = f"{_VERSIONS}/{uuid.uuid4().hex}"
        before = snapshots.versions()
        self._after = before[-1] if before else 0
        self._named = snapshots._named(self._after) if before else {}

    def path(self, name: str) -> str:
        """Where files of this version go that are no tables."""
        return f"{self.snapshots.root}/{self.folder}/{name}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write a table of this version; returns the written table."""
        if {"\t", "\n", "/"} & set(name):
            raise ValueError(f"not a table name: {name!r}")
        df.write.parquet(self.path(name))
        self._named[name] = f"{self.folder}/{name}"
        return df.sparkSession.read.schema(df.schema).parquet(self.path(name))

    def publish(self) -> int:
        """Make this the current version; an error if another was published meanwhile."""
        return self.snapshots._publish(self._after, self._named)

    def __enter__(self) -> Draft:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is None:
            self.publish()
