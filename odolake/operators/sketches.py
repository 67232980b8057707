"""Stored daily sketches that answer for any span of days: distinct vehicles and quantiles, both approximate.

A day is summed up once, in a few kilobytes, combined before the shuffle; a span merges its days' sketches
and reads no row again. The exact forms (``countDistinct``, ``quantile.exact_quantile``) stay the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12  # HyperLogLog registers as a power of two: a standard error of about 1.6 %
KLL_SIZE = 1024  # a rank error well below half a percent


def daily_vehicles(events: DataFrame, time: str = "received_at", key: str = "vehicle_id", log_buckets: int = LOG_BUCKETS) -> DataFrame:
    """``day, seen``: a sketch of the vehicles heard from on each day."""
    return events.groupBy(F.to_date(time).alias("day")).agg(F.hll_sketch_agg(key, F.lit(log_buckets)).alias("seen"))


def distinct_vehicles(days: DataFrame, *by: Column) -> DataFrame:
    """About how many vehicles the days of each group saw together."""
    return days.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("seen")).alias("vehicles"))


def daily_values(rows: DataFrame, column: str, time: str, size: int = KLL_SIZE) -> DataFrame:
    """``day, spread``: a sketch of the distribution of ``column`` on each day."""
    known = rows.where(F.col(column).isNotNull())
    return known.groupBy(F.to_date(time).alias("day")).agg(F.kll_sketch_agg_double(F.col(column), F.lit(size)).alias("spread"))


def merged_quantiles(days: DataFrame, shares: list[float]) -> list[float]:
    """About the values below which these shares of all rows of the days lie; empty without a row."""
    whole = days.agg(F.kll_merge_agg_double("spread").alias("s"), F.count("spread").alias("n"))
    wanted = F.array(*[F.kll_sketch_get_quantile_double("s", F.lit(q)) for q in shares])
    row = whole.select(F.when(F.col("n") > 0, wanted).alias("v")).first()
    return list(row.v or [])
