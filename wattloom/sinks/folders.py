"""Folders of tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """The table's file system through Hadoop's API, which every Spark deployment has."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, path: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isDirectory()]

    def newest_first(self, path: str) -> list[str]:
        found = [s for s in self.fs.listStatus(self._path(path)) if s.isDirectory()]
        return [s.getPath().getName() for s in sorted(found, key=lambda s: -s.getModificationTime())]

    def size(self, path: str) -> tuple[int, int]:
        """Bytes and number of the data files below a folder."""
        size = count = 0
        files = self.fs.listFiles(self._path(path), True)
        while files.hasNext():
            file = files.next()
            if not file.getPath().getName().startswith(("_", ".")):
                size, count = size + file.getLen(), count + 1
        return size, count

    def modified(self, path: str) -> dict[str, int]:
        """Folders in a folder, with the time each was written at; none where there is no such folder."""
        if not self.exists(path):
            return {}
        found = self.fs.listStatus(self._path(path))
        return {s.getPath().getName(): s.getModificationTime() for s in found if s.isDirectory()}

    def make(self, path: str) -> None:
        self.fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def drop(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def files(self, path: str) -> list[str]:
        """Names of the files in a folder; none where there is no such folder."""
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(path)) if s.isFile()]

    def mark(self, path: str) -> None:
        """Create an empty file that must not exist yet."""
        self.fs.create(self._path(path), False).close()

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))
