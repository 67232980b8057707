"""Retention, pseudonyms, anonymous aggregates and operational alarms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.functions.timing import instant


def retained(df: DataFrame, time: str, as_of, keep: str) -> DataFrame:
    """Rows young enough to keep; ``keep`` is an interval such as ``3 YEARS``."""
    return df.where(F.col(time) >= instant(as_of) - F.expr(f"INTERVAL {keep}"))


def pseudonym(key, salt: str):
    return F.sha2(F.concat(F.lit(salt), key), 256)


def pseudonymised(df: DataFrame, salt: str, key: str = "vehicle_id") -> DataFrame:
    """The table under pseudonyms; the mapping is kept apart."""
    return df.select(*[pseudonym(F.col(key), salt).alias(key) if c == key else F.col(c) for c in df.columns])


def pseudonym_map(dimension: DataFrame, salt: str, key: str = "vehicle_id") -> DataFrame:
    return dimension.select(key, pseudonym(F.col(key), salt).alias("pseudonym")).distinct()


def anonymous_by_group(
    gold: DataFrame, dimension: DataFrame, by: str = "region", k: int = 3, key: str = "vehicle_id"
) -> DataFrame:
    """Fleet aggregates per group, only for groups of at least ``k`` vehicles.

    Health rows are first summed per vehicle, so the distinct count needs no second
    expansion and a group with a third of all rows is already small.
    """
    per_vehicle = gold.groupBy(key).agg(
        F.sum("avg_battery_pct").alias("_battery"), F.sum("health_score").alias("_health"), F.count("*").alias("_n")
    )
    return (
        per_vehicle.join(dimension.select(key, by), key)
        .groupBy(by)
        .agg(
            F.count("*").alias("vehicles"),
            F.round(F.sum("_battery") / F.sum("_n"), 1).alias("avg_battery_pct"),
            F.round(F.sum("_health") / F.sum("_n"), 1).alias("avg_health_score"),
            F.sum("_n").alias("health_rows"),
        )
        .where(F.col("vehicles") >= k)
    )


def operational_alarms(dlq: DataFrame, stage_health: DataFrame, dlq_depth: int = 100, silent_seconds: float = 90) -> DataFrame:
    """(alarm, value) rows: a dead-letter table too deep, stages silent for too long."""
    depth = dlq.agg(F.count("*").alias("value")).select(F.lit("dlq_depth").alias("alarm"), "value")
    silent = stage_health.where(F.col("lag_seconds") > silent_seconds).select(
        F.concat(F.lit("stage_silent:"), "stage").alias("alarm"), F.col("lag_seconds").alias("value")
    )
    return depth.where(F.col("value") > dlq_depth).unionByName(silent)
