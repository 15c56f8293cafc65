"""Listing, reading and publishing small files where Spark keeps its tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """The file system that holds a path, whatever its kind."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.system = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        """Names in a folder; none where it does not exist."""
        place = self.path(folder)
        if not self.system.exists(place):
            return []
        return sorted(s.getPath().getName() for s in self.system.listStatus(place))

    def matching(self, pattern: str) -> list[str]:
        """Visible paths that match a glob pattern."""
        found = self.system.globStatus(self.path(pattern)) or []
        paths = [s.getPath() for s in found]
        return sorted(p.toString() for p in paths if p.getName()[:1] not in "._")

    def remove(self, path: str) -> None:
        self.system.delete(self.path(path), True)

    def read(self, path: str) -> str:
        stream = self.system.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, text: str, path: str) -> None:
        """A file that is there whole or not at all."""
        staged = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self.system.create(self.path(staged), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.system.rename(self.path(staged), self.path(path)):
            raise OSError(f"cannot publish {path}")
