"""Folders below a shared path, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, below: str = "") -> list[str]:
        """Names of the entries of a folder; none if it is not there."""
        at = self._path(f"{self.path}/{below}" if below else self.path)
        if not self._fs.exists(at):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(at))

    def drop(self, below: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{below}"), True)
