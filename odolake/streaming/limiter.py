"""Token buckets of a stream, carried from micro-batch to micro-batch.

A micro-batch is decided like a whole history: sorted by ranges of (key, time, id), so that the events of one
hot key are shared out over tasks, with the state of each bucket as one more row before its events. What
is carried is the instant at which a bucket will be full again, one row per bucket that is not full,
written under the number of the micro-batch. A repeated micro-batch starts from the same states and
comes to the same answers. States go by the time of the events, never by the clock: a bucket is
forgotten once it was full ``lateness_seconds`` before the newest event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.functions.timing import MICROS
from odolake.operators.rate_limit import token_bucket_step
from odolake.sources.versions import Versions

_STATES = "key STRING, full_at BIGINT"


class CarriedBuckets:
    """The buckets of one query, below a folder of its checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, capacity: int = 3, refill_per_second: float = 0.25,
                 lateness_seconds: float = 60):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.states = Versions(spark, f"{self.folder}/states", _STATES)
        self.capacity, self.refill, self.lateness = capacity, refill_per_second, round(lateness_seconds * MICROS)

    def decide(self, events: DataFrame, batch_id: int, key: str = "vehicle_id", time: str = "received_at",
               ident: str = "id", partitions: int | None = None) -> DataFrame:
        """(id, allowed) of the events of a micro-batch, readable until the next but one; the states after it are stored."""
        before = self.states.before(batch_id)  # the row without a key holds the newest time seen
        verdicts, after = token_bucket_step(
            events, before.where(F.col("key").isNotNull()), f"{self.folder}/decided={batch_id % 2}", key, time, ident,
            self.capacity, self.refill, partitions)
        seen = events.select(F.unix_micros(time).alias("full_at")).unionByName(
            before.where(F.col("key").isNull()).select("full_at"))
        newest = seen.agg(F.max("full_at").alias("full_at")).first().full_at
        if newest is None:
            return verdicts
        mark = self.spark.createDataFrame([(None, newest)], _STATES)
        self.states.write(batch_id, after.where(F.col("full_at") > newest - self.lateness).unionByName(mark))
        return verdicts
