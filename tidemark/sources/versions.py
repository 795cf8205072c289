"""Tables that are replaced as a whole while others read them.

Each version is a folder of its own, written in full before anyone can see it.
An empty file, whose name has the time and the version, then publishes it: it is
there or it is not, on every file system, and nothing is overwritten. The
current version is that of the latest such file. A reader looks once and stays
with that version's files; a reader that comes later gets the next. Versions
that are neither current nor young are removed by ``vacuum``.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

PUBLISHED, VERSIONS = "published", "versions"


class VersionedTable:
    """A Parquet table below ``path``, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- Hadoop's file interface, so that any path Spark can write will do
    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folder(self, version: str) -> str:
        return f"{self.path}/{VERSIONS}/{version}"

    def _names(self, folder: str) -> list[str]:
        """What is in a folder below the table, in order, hidden files left out."""
        at, files = self._hadoop(f"{self.path}/{folder}"), self._files()
        try:
            found = files.listStatus(at)
        except Exception as e:
            if "FileNotFoundException" in str(e):
                return []
            raise
        return sorted(n for n in (f.getPath().getName() for f in found) if not n.startswith((".", "_")))

    def current(self) -> str | None:
        """The name of the current version; None before the first."""
        marks = self._names(PUBLISHED)
        return marks[-1].split(".")[1] if marks else None

    def exists(self) -> bool:
        return self.current() is not None

    def location(self, version: str | None = None) -> str:
        """The folder of a version, by default of the current one."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self._folder(version)

    def read(self, version: str | None = None) -> DataFrame:
        """The table as of now, pinned: what is published later does not change this frame."""
        return self.spark.read.parquet(self.location(version))

    def stage(self, df: DataFrame, cluster_by: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> str:
        """Write ``df`` as a version that nobody reads yet; returns its name.

        ``cluster_by`` sorts rows within each file, without a shuffle, so that
        row-group statistics let range filters on those columns skip data.
        """
        version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        if cluster_by:
            df = df.sortWithinPartitions(*cluster_by)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(self._folder(version))
        return version

    def publish(self, version: str) -> None:
        """Make a staged version the current one, in one step."""
        mark = self._hadoop(f"{self.path}/{PUBLISHED}/{time.time_ns():020d}.{version}")
        self._files().create(mark, False).close()

    def replace(self, df: DataFrame, cluster_by: tuple[str, ...] = (), partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write and publish a new version; returns a reader pinned to it.

        ``df`` may read the table itself: it reads the version before.
        """
        version = self.stage(df, cluster_by, partition_by)
        self.publish(version)
        return self.read(version)

    def versions(self) -> list[str]:
        """All versions that are there, published or not, the oldest first."""
        return self._names(VERSIONS)

    def vacuum(self, older_than: float) -> list[str]:
        """Remove versions that stopped being current more than ``older_than`` seconds ago; returns them.

        Jobs that read a version for longer than that have to be counted on by
        whoever sets it. Versions that are not published yet stay.
        """
        marks, now, gone = self._names(PUBLISHED), time.time_ns(), []
        current = self.current()
        for mark, follower in zip(marks, marks[1:]):
            version = mark.split(".")[1]
            if version == current or now - int(follower.split(".")[0]) <= older_than * 1e9:
                continue
            self._files().delete(self._hadoop(self._folder(version)), True)
            self._files().delete(self._hadoop(f"{self.path}/{PUBLISHED}/{mark}"), False)
            gone.append(version)
        return gone
