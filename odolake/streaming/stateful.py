"""Keyed state for streams: token bucket and alert suppression, as plain DataFrames.

Both keep a few numbers per key in the state store and go through the rows of a key in
time order within a micro-batch, whose size the source options bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from odolake import schemas as S
from odolake.functions.timing import MICROS
from odolake.operators.rate_limit import bucket_times, decide

_NEVER = -(2**62)


class BucketProcessor(StatefulProcessor):
    """Token bucket of one key; the state is the time at which the bucket is full again."""

    def __init__(self, interval: int, slack: int):
        self.interval, self.slack = interval, slack

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.full_at = handle.getValueState("full_at", "full_at BIGINT")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        arrivals = pd.concat(list(rows)).sort_values(["t", "id"])
        state = self.full_at.get()[0] if self.full_at.exists() else _NEVER
        state, allowed = decide(state, arrivals["t"].tolist(), self.interval, self.slack)
        self.full_at.update((state,))
        yield pd.DataFrame({"id": arrivals["id"].to_numpy(), "allowed": allowed})

    def close(self) -> None:
        pass


def limit_stream(events: DataFrame, key: str = "vehicle_id", time: str = "received_at", ident: str = "id",
                 capacity: int = 3, refill_per_second: float = 0.25) -> DataFrame:
    """(id, allowed) for every event of a stream."""
    interval, slack = bucket_times(capacity, refill_per_second)
    arrivals = events.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.unix_micros(time).alias("t"), F.col(ident).alias("id")
    )
    return arrivals.groupBy("key").transformWithStateInPandas(
        statefulProcessor=BucketProcessor(interval, slack), outputStructType="id BIGINT, allowed BOOLEAN",
        outputMode="append", timeMode="none",
    )


class AlertProcessor(StatefulProcessor):
    """Run length of anomalous windows and the last alert of one vehicle."""

    FIELDS = "last_window BIGINT, run INT, run_started BIGINT, alert_at BIGINT, alert_score DOUBLE"

    def __init__(self, consecutive: int, quiet: int, factor: float):
        self.consecutive, self.quiet, self.factor = consecutive, quiet, factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.memory = handle.getValueState("memory", self.FIELDS)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = pd.concat(list(rows)).sort_values(["w", "t", "anomaly_score"]).drop_duplicates("w")
        last, run, started, alert_at, alert_score = (
            self.memory.get() if self.memory.exists() else (_NEVER, 0, _NEVER, _NEVER, 0.0)
        )
        raised = []
        for w, t, score, bad in zip(seen["w"], seen["t"], seen["anomaly_score"], seen["is_anomaly"]):
            if w <= last:
                continue
            started = started if run else w
            last, run = w, run + 1 if bad else 0
            if run < self.consecutive:
                continue
            if alert_at == _NEVER or alert_at < t - self.quiet or abs(score) > abs(alert_score) * self.factor:
                alert_at, alert_score = t, score
                raised.append((key[0], w, started, score, t))
        self.memory.update((int(last), int(run), int(started), int(alert_at), float(alert_score)))
        yield pd.DataFrame(raised, columns=["vehicle_id", "w", "s", "anomaly_score", "t"])

    def close(self) -> None:
        pass


def alert_stream(predictions: DataFrame, consecutive: int = 2, suppression_hours: float = 4, factor: float = 1.2,
                 mode: str = "production") -> DataFrame:
    """Alerts of a stream of predictions; other modes never alert."""
    quiet = round(suppression_hours * 3600 * MICROS)
    rows = predictions.where((F.col("mode") == mode) & (F.col("vehicle_id") != S.ERASED)).select(
        "vehicle_id", F.unix_micros("window_start").alias("w"), F.unix_micros("predicted_at").alias("t"),
        "anomaly_score", "is_anomaly",
    )
    raised = rows.groupBy("vehicle_id").transformWithStateInPandas(
        statefulProcessor=AlertProcessor(consecutive, quiet, factor),
        outputStructType="vehicle_id STRING, w BIGINT, s BIGINT, anomaly_score DOUBLE, t BIGINT",
        outputMode="append", timeMode="none",
    )
    return raised.select(
        "vehicle_id", F.timestamp_micros("w").alias("first_detected_at"), F.timestamp_micros("s").alias("run_started_at"),
        "anomaly_score", F.lit("open").alias("status"), F.timestamp_micros("t").alias("created_at"),
    )
