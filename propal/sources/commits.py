"""Small JSON files beside a table or a saved model that say which of its folders count."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class SmallFiles:
    """JSON files under a folder of any file system that Spark reads, each written whole or not at all."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        fs, path = self._fs(), self._path(folder)
        if not fs.exists(path):
            return []
        return sorted(n for s in fs.listStatus(path) if (n := s.getPath().getName()).endswith(".json"))

    def _write(self, name: str, value: dict) -> bool:
        """A new file, whole or not at all; False where it exists."""
        fs, path = self._fs(), self._path(name)
        if fs.exists(path):
            return False
        beside = self._path(f"writing/{uuid.uuid4().hex}")
        out = fs.create(beside, True)
        out.write(bytearray(json.dumps(value).encode()))
        out.close()
        fs.mkdirs(path.getParent())
        return fs.rename(beside, path)

    def _read(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/{name}", wholetext=True).first()[0])
