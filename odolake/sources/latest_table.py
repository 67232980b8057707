"""The newest rows per key as a stored table that every batch brings up to date.

Readers of the newest state then read a row per key instead of the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from odolake.operators.latest import merged_latest
from odolake.sources.versions import Versions


class LatestTable:
    """Newest rows of ``schema`` by ``order`` for every ``key``; ties stay."""

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType | str, key: str = "vehicle_id",
                 order: str = "event_timestamp"):
        self.versions, self.key, self.order = Versions(spark, folder, schema), key, order

    def update(self, rows: DataFrame, batch_id: int) -> None:
        """Take the rows of a batch in, in whatever order batches come; a repeated batch changes nothing."""
        stored = self.versions.before(batch_id)
        self.versions.write(batch_id, merged_latest(stored, rows, self.key, self.order))

    def read(self) -> DataFrame:
        return self.versions.newest()
