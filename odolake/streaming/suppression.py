"""Alerts of a stream of predictions, with what a vehicle's next alert depends on carried from batch to batch.

A micro-batch is first reduced to one row per vehicle and window, combined before the shuffle, so a vehicle
is no heavier than its windows however often they were scored. What is carried is one row per vehicle: its last
window, the run of anomalous windows that ends there, and its last alert. A vehicle that was silent for longer than
the horizon starts anew, as the batch cycle looks back no further either, and its row is dropped. A repeated
micro-batch starts from the same rows and raises the same alerts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.functions.numeric import worsened
from odolake.functions.timing import MICROS
from odolake.operators.alerting import PRODUCTION, one_per_window
from odolake.session import pinned
from odolake.sources.versions import Versions

_MEMORY = {"last": "BIGINT", "run": "INT", "started": "BIGINT", "alert_at": "BIGINT", "alert_score": "DOUBLE"}
_RAISED = "array<struct<w: bigint, s: bigint, anomaly_score: double, t: bigint>>"


class CarriedAlerts:
    """The run lengths and last alerts of one query, below a folder of its checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, consecutive: int = 2, suppression_hours: float = 4,
                 factor: float = 1.2, mode: str = PRODUCTION, horizon_days: float = 30):
        self.consecutive, self.factor, self.mode = consecutive, factor, mode
        self.quiet, self.horizon = round(suppression_hours * 3600 * MICROS), round(horizon_days * 86_400 * MICROS)
        if self.horizon < self.quiet:
            raise ValueError("the horizon must not be shorter than the quiet time")
        fields = ", ".join(f"{name} {kind}" for name, kind in _MEMORY.items())
        self.spark, self.versions = spark, Versions(spark, folder, f"vehicle_id STRING, {fields}")

    def _follow(self, windows: Column) -> Column:
        """The memory after the windows of one vehicle, in time order, and the alerts they raise."""
        start = F.struct(*[F.col(name).cast(kind).alias(name) for name, kind in _MEMORY.items()],
                         F.array().cast(_RAISED).alias("raised"))

        def follow(memory: Column, c: Column) -> Column:
            known = memory["last"].isNotNull() & (c["w"] - memory["last"] <= F.lit(self.horizon))
            so_far = F.when(known, memory["run"]).otherwise(F.lit(0))
            started = F.when(so_far > 0, memory["started"]).otherwise(c["w"])
            run = F.when(c["bad"], so_far + 1).otherwise(F.lit(0))
            alert_at = F.when(known, memory["alert_at"])
            due = alert_at.isNull() | (alert_at < c["t"] - F.lit(self.quiet)) | worsened(
                c["score"], memory["alert_score"], self.factor)
            fires = F.coalesce((run >= self.consecutive) & due, F.lit(False))
            alert = F.struct(c["w"].alias("w"), started.alias("s"), c["score"].alias("anomaly_score"), c["t"].alias("t"))
            after = F.struct(
                c["w"].alias("last"), run.cast("int").alias("run"), started.alias("started"),
                F.when(fires, c["t"]).otherwise(alert_at).alias("alert_at"),
                F.when(fires, c["score"]).otherwise(memory["alert_score"]).alias("alert_score"),
                F.when(fires, F.concat(memory["raised"], F.array(alert))).otherwise(memory["raised"]).alias("raised"))
            # a window that is scored again, or comes after a later one, changes nothing
            return F.when(memory["last"] >= c["w"], memory).otherwise(after)

        return F.aggregate(windows, start, follow)

    def update(self, predictions: DataFrame, batch_id: int) -> DataFrame:
        """The alerts a micro-batch raises. Windows older than the horizon, counted from the newest so far, are passed over."""
        before = self.versions.before(batch_id)
        mark = before.where(F.col("vehicle_id").isNull()).first()  # its last window is the newest of all vehicles
        window = F.struct(F.unix_micros("window_start").alias("w"), F.unix_micros("predicted_at").alias("t"),
                          F.col("anomaly_score").alias("score"), F.coalesce("is_anomaly", F.lit(False)).alias("bad"))
        scored = predictions.where(F.col("window_start").isNotNull())
        if mark is not None:
            scored = scored.where(F.unix_micros("window_start") >= mark["last"] - self.horizon)
        windows = one_per_window(scored, self.mode).groupBy("vehicle_id").agg(
            F.array_sort(F.collect_list(window)).alias("windows"))
        met = before.where(F.col("vehicle_id").isNotNull()).join(windows, "vehicle_id", "full")
        listed = F.coalesce("windows", F.array().cast(windows.schema["windows"].dataType))
        followed = pinned(met.select("vehicle_id", self._follow(listed).alias("memory")))
        newest = followed.agg(F.max("memory.last").alias("last")).first()["last"]
        newest = max((t for t in (newest, mark and mark["last"]) if t is not None), default=None)
        if newest is not None:
            kept = followed.select("vehicle_id", *[f"memory.{name}" for name in _MEMORY]).where(
                F.col("last") >= newest - self.horizon)
            line = self.spark.range(1).select(
                F.lit(None).cast("string").alias("vehicle_id"), F.lit(newest).cast("bigint").alias("last"))
            self.versions.write(batch_id, kept.unionByName(line, allowMissingColumns=True))
        return followed.select("vehicle_id", F.inline("memory.raised")).select(
            "vehicle_id", F.timestamp_micros("w").alias("first_detected_at"), F.timestamp_micros("s").alias("run_started_at"),
            "anomaly_score", F.lit("open").alias("status"), F.timestamp_micros("t").alias("created_at"))
