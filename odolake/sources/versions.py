"""Small tables that a stream or a cycle carries along: a whole version per batch number.

Such a table has a row per vehicle, window or bucket, not per event, so it is written anew with every batch.
A repeated batch reads the version before it once more and comes to the same result. Readers take
the newest complete version; the one before it stays for those that have begun to read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT = 3  # versions that stay


class Versions:
    """Versions of one table below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, schema: str | T.StructType):
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Batches whose version is completely written."""
        path, files = self._path("after=*/_SUCCESS")
        found = files.globStatus(path) or []
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)

    def _read(self, numbers: list[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/after={numbers[-1]}")

    def before(self, batch_id: int) -> DataFrame:
        """The table as it was before a batch; empty at the beginning."""
        return self._read([n for n in self.numbers() if n < batch_id])

    def newest(self) -> DataFrame:
        return self._read(self.numbers())

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """The table after a batch; a repeated batch replaces its version."""
        rows.write.mode("overwrite").parquet(f"{self.folder}/after={batch_id}")
        for old in [n for n in self.numbers() if n < batch_id][:1 - KEPT]:
            path, files = self._path(f"after={old}")
            files.delete(path, True)
