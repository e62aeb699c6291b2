"""Small driver-side records (ledgers, manifests) in the shared folder, through
Spark's file systems: local, HDFS or an object store alike."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession


class Folder:
    """A folder of JSON records. A record is replaced by writing beside it and
    renaming, so a reader sees the old one or the new one, never half of it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.fs.mkdirs(self._path(""))

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def put(self, name: str, record: Any) -> None:
        fresh = self._path(f".{name}.new")
        out = self.fs.create(fresh, True)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        target = self._path(name)
        if self.fs.exists(target):
            self.fs.delete(target, False)
        if not self.fs.rename(fresh, target):
            raise OSError(f"cannot put {name} into {self.path}")

    def get(self, name: str, default: Any = None) -> Any:
        """The record, or the one that a broken-off ``put`` left beside it."""
        for path in (self._path(name), self._path(f".{name}.new")):
            if self.fs.exists(path):
                stream = self.fs.open(path)
                try:
                    return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                finally:
                    stream.close()
        return default

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path("")))

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
