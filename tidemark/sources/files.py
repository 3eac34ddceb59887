"""Hadoop file system calls (rename, delete, list) through the session's JVM."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Entry names of a folder; empty if it is not there."""
        if not self.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._fs.listStatus(self._path(path)))

    def size(self, path: str) -> int:
        """Bytes under a file or folder."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def age(self, path: str) -> float:
        """Seconds since the folder or file was last changed, by the clock of this machine."""
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def rename(self, source: str, target: str) -> None:
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
