"""Small file operations on the cluster's file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Driver-side access to commit records and folder names; never to table data."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def _at(self, *parts: str):
        where = self._jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        return where.getFileSystem(self._conf), where

    def names(self, *parts: str) -> list[str]:
        fs, where = self._at(*parts)
        if not fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(where))

    def read_text(self, *parts: str) -> str:
        fs, where = self._at(*parts)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, text: str, *parts: str) -> bool:
        """Write under a temporary name, then rename; False if the name is already taken."""
        fs, where = self._at(*parts)
        _, temporary = self._at(*parts[:-1], f".{parts[-1]}.{uuid.uuid4().hex}")
        if fs.exists(where):
            return False
        stream = fs.create(temporary, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        if fs.rename(temporary, where):
            return True
        fs.delete(temporary, False)
        return False

    def delete(self, *parts: str) -> None:
        fs, where = self._at(*parts)
        fs.delete(where, True)
