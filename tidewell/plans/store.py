"""Small files of the control plane, in whatever file system Spark can reach.

Files are written under a temporary name and renamed, so a reader sees the old or the new content,
never half of it.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import SparkSession

from tidewell.functions.identity import new_id


class Store:
    """JSON documents and folders below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}" if name else self.root

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def names(self, folder: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._at(folder))) if self.exists(folder) else []

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def put(self, name: str, value: Any) -> None:
        """Replaces a document atomically."""
        target, fresh = self._at(name), self._at(f"{name}.{new_id()}.tmp")
        self._fs.mkdirs(target.getParent())
        self._write(fresh, value)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        overwrite = self.spark.sparkContext._gateway.new_array(options, 1)
        overwrite[0] = options.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(fresh, target, overwrite)

    def create(self, name: str, value: Any) -> bool:
        """Writes a document only if there is none; False if there is: a lock that one writer gets."""
        target = self._at(name)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target):
            return False
        try:
            out = self._fs.create(target, False)
        except Exception as error:
            if self._fs.exists(target):
                return False
            raise error
        self._finish(out, value)
        return True

    def _write(self, at, value: Any) -> None:
        self._finish(self._fs.create(at, True), value)

    @staticmethod
    def _finish(out, value: Any) -> None:
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True, default=str).encode()))
        finally:
            out.close()

    def get(self, name: str, default: Any = None) -> Any:
        if not self.exists(name):
            return default
        source = self._fs.open(self._at(name))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
        finally:
            source.close()
