"""Stage alarms with a clock set by hand, drift, and sketches."""

import time
from datetime import timedelta

from conftest import NOW, ended
from pyspark.sql import functions as F

from odolake.operators import drift, sketches
from odolake.streaming.watch import StageWatch, observed


def test_a_stage_that_falls_silent_is_named(spark, tmp_path):
    clock = [1000.0]
    watch = StageWatch(90, lambda: clock[0])
    spark.streams.addListener(watch)
    try:
        source = tmp_path / "in"
        spark.range(7).write.parquet(str(source))
        rows = observed(spark.readStream.schema("id BIGINT").parquet(str(source)).where("id > 2"))
        query = rows.writeStream.format("noop").queryName("cleaning").option(
            "checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
        until = time.time() + 60
        while watch.totals.get("cleaning", 0) < 4 and time.time() < until:
            time.sleep(0.2)
        assert watch.totals["cleaning"] == 4  # rows that passed the filter
        clock[0] = 1089.0
        assert watch.alarms() == {}
        clock[0] = 1091.0
        assert watch.alarms() == {"cleaning": 91.0}
        spark.range(7, 9).write.mode("append").parquet(str(source))
        while watch.totals["cleaning"] < 6 and time.time() < until:
            time.sleep(0.2)
        assert watch.alarms() == {}  # heard from again
        query.stop()
        clock[0] = 5000.0
        while watch.alarms() and time.time() < until:
            time.sleep(0.2)
        assert watch.alarms() == {}  # it has ended, and is not silent
    finally:
        spark.streams.removeListener(watch)


def test_drift_is_the_distance_of_histograms(spark):
    rows = [(NOW + timedelta(days=d), float(x)) for d, values in enumerate([[1, 1, 12, 12], [1, 12], [1, 1], [55, -9]]) for x in values]
    scores = spark.createDataFrame([*rows, (NOW, None)], "at TIMESTAMP, score DOUBLE")
    far = drift.daily_distance(scores, "score", "at", F.lit(NOW + timedelta(days=1)), 0.0, 10.0, 3)
    out = {str(r.day): (r.rows, r.distance) for r in far.collect()}
    day = lambda n: str((NOW + timedelta(days=n)).date())
    assert out == {day(1): (2, 0.0), day(2): (2, 0.5), day(3): (2, 0.5)}  # beyond the ends: the outer bins
    assert drift.retrain_due(far, 0.4) and not drift.retrain_due(far, 0.6) and not drift.retrain_due(far, 0.4, least_rows=9)
    assert drift.daily_distance(scores, "score", "at", F.lit(NOW - timedelta(days=9)), 0.0, 10.0, 3).count() == 0


def test_sketches_of_days_answer_for_any_span(spark):
    rows = spark.range(60_000).select(
        F.timestamp_micros(F.lit(10**15) + F.col("id") * 10_000_000).alias("received_at"),
        F.format_string("v%d", F.pmod(F.xxhash64("id"), F.lit(3000))).alias("vehicle_id"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10_000)) / 100).alias("score"))
    days = sketches.daily_vehicles(rows)
    assert abs(sketches.distinct_vehicles(days).first().vehicles - 3000) < 150
    spread = sketches.daily_values(rows, "score", "received_at")
    shares = [0.01, 0.05, 0.5, 0.99]
    for share, value in zip(shares, sketches.merged_quantiles(spread, shares)):
        assert abs(rows.where(F.col("score") <= value).count() / 60_000 - share) <= 0.005
    assert sketches.merged_quantiles(spread.limit(0), shares) == []
