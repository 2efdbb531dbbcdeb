"""Small files next to tables, on any file system Spark can write."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.base = spark, path.rstrip("/")
        self.hadoop = spark._jvm.org.apache.hadoop.fs
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        self.system = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.hadoop.Path(f"{self.base}/{name}" if name else self.base)

    def children(self, name: str = "") -> dict[str, int]:
        """Names in a folder with their times of change (ms); empty if there is no such folder."""
        if not self.system.exists(self._path(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.system.listStatus(self._path(name))}

    def read(self, name: str) -> str:
        return self.spark.read.text(f"{self.base}/{name}", wholetext=True).first()[0]

    def create(self, name: str, text: str) -> bool:
        """Write a new file whole or not at all; ``False`` if it exists already."""
        hidden = self._path(f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}")
        out = self.system.create(hidden, True)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.hadoop.FileContext.getFileContext(hidden.toUri(), self.conf)
        options = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 0)  # none: never overwrite
        try:
            context.rename(self.system.makeQualified(hidden), self.system.makeQualified(self._path(name)), options)
            return True
        except Py4JJavaError as error:
            self.system.delete(hidden, False)
            if "FileAlreadyExists" in str(error.java_exception.toString()):
                return False
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self._path(name), True)
