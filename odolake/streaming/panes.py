"""Sliding health windows of a stream from carried panes, and the readings that came too late for them.

A micro-batch is first reduced to one pane per vehicle and slide, combined before the shuffle, so a hot
vehicle is no heavier than any other and no reading is copied into the windows that overlap it. Panes
are merged with those carried so far. The watermark follows the newest reading at a distance of the
allowed lateness; panes that it passes are closed, and each closes one window, whose look-back reads
the carried panes. A reading whose pane was closed before its micro-batch is late: it goes to the side
output, so readings on time and late ones make up all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.timing import MICROS
from odolake.operators import health
from odolake.session import pinned
from odolake.sources.versions import Versions

_MOMENT = "STRUCT<event_timestamp: TIMESTAMP, bronze_id: BIGINT, battery_pct: DOUBLE>"
PANES = ("vehicle_id STRING, pane BIGINT, record_count BIGINT, " + ", ".join(f"sum_{m} DOUBLE" for m in health.AVERAGED)
         + f", head {_MOMENT}, tail {_MOMENT}")


def pane_of(time: Column, slide_seconds: int) -> Column:
    """Start of the slide that a time falls into, in microseconds."""
    micros = F.unix_micros(time)
    return micros - F.pmod(micros, F.lit(slide_seconds * MICROS))


def panes(silver: DataFrame, slide_seconds: int) -> DataFrame:
    """One row per vehicle and slide: sums, number, first and last reading."""
    moment = F.struct("event_timestamp", "bronze_id", "battery_pct")
    return silver.groupBy("vehicle_id", pane_of(F.col("event_timestamp"), slide_seconds).alias("pane")).agg(
        F.count("*").alias("record_count"), *[F.sum(m).alias(f"sum_{m}") for m in health.AVERAGED],
        F.min(moment).alias("head"), F.max(moment).alias("tail"))


def merged(parts: DataFrame) -> DataFrame:
    """Panes from several parts of the same readings' panes."""
    return parts.groupBy("vehicle_id", "pane").agg(
        F.sum("record_count").alias("record_count"), *[F.sum(f"sum_{m}").alias(f"sum_{m}") for m in health.AVERAGED],
        F.min("head").alias("head"), F.max("tail").alias("tail"))


def pane_windows(rows: DataFrame, slide_seconds: int, lookback_seconds: int, unit_minutes: float = 1.0) -> DataFrame:
    """The health row of the window that each pane closes."""
    back = health.Window.partitionBy("vehicle_id").orderBy("pane").rangeBetween(
        -(lookback_seconds - slide_seconds) * MICROS, 0)
    rate = health.discharge_rate(
        F.col("_old.battery_pct"), F.col("tail.battery_pct"), F.col("_old.event_timestamp"), F.col("tail.event_timestamp"),
        unit_minutes)
    seen = rows.withColumn("_old", F.first("head").over(back)).withColumn("_rate", rate)
    means = {f"_m_{m}": F.col(f"sum_{m}") / F.col("record_count") for m in health.AVERAGED}
    end = F.timestamp_micros(F.col("pane") + F.lit(slide_seconds * MICROS))
    return seen.withColumns(means).select(*health.gold_columns(F.timestamp_micros("pane"), end, end), "pane")


class CarriedPanes:
    """The open panes of one query and those that later look-backs need, below a folder of its checkpoint."""

    def __init__(self, spark: SparkSession, folder: str, slide_seconds: int = 30, lookback_seconds: int = 300,
                 unit_minutes: float = 1.0, lateness_seconds: float = 60):
        if lookback_seconds % slide_seconds:
            raise ValueError("the look-back must be a whole number of slides")
        self.spark, self.versions = spark, Versions(spark, folder, PANES)
        self.slide, self.lookback, self.unit = slide_seconds, lookback_seconds, unit_minutes
        self.lateness = round(lateness_seconds * MICROS)

    def update(self, silver: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """Health rows of the windows that a micro-batch closes, and its late readings. Erased vehicles are left out."""
        rows = silver.where(F.col("vehicle_id") != S.ERASED)
        before = self.versions.before(batch_id)
        mark = before.where(F.col("vehicle_id").isNull()).first()  # its pane is the watermark
        closed = mark.pane if mark else None
        end = F.col("pane") + F.lit(self.slide * MICROS)
        late = F.lit(False) if closed is None else end <= closed
        rows = rows.withColumn("pane", pane_of(F.col("event_timestamp"), self.slide))
        newest = rows.agg(F.max("event_timestamp").alias("t")).select(F.unix_micros("t").alias("t")).first().t
        now = max([t for t in (closed, None if newest is None else newest - self.lateness) if t is not None], default=None)
        carried = before.where(F.col("vehicle_id").isNotNull())
        fresh = panes(rows.where(~late).drop("pane"), self.slide)
        together = pinned(merged(carried.unionByName(fresh)))
        if now is None:
            return pane_windows(together, self.slide, self.lookback, self.unit).where(F.lit(False)).drop("pane"), rows.where(late)
        done = end <= now
        if closed is not None:
            done = done & (end > closed)
        windows = pane_windows(together, self.slide, self.lookback, self.unit).where(done).drop("pane")
        kept = together.where(F.col("pane") >= now - self.lookback * MICROS)
        line = self.spark.range(1).select(
            F.lit(None).cast("string").alias("vehicle_id"), F.lit(now).cast("bigint").alias("pane"))
        self.versions.write(batch_id, kept.unionByName(line, allowMissingColumns=True))
        return windows, rows.where(late).drop("pane")
