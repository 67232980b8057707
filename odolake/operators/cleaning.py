"""Raw layer to cleaned layer: enrichment, rejects, incremental batches, circuit breaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.operators.validation import range_failure

_DIMENSION = ("rated_capacity_kwh", "manufacture_year", "region")


def enrich(bronze: DataFrame, vehicles: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Left join of the vehicle dimension.

    No hint: the dimension is a stored table, so Catalyst knows its size and broadcasts it
    only below ``autoBroadcastJoinThreshold``; beyond that the join shuffles, and the
    adaptive skew join splits the partition of a hot vehicle.
    """
    return bronze.join(vehicles.select(key, *_DIMENSION), key, "left")


def skip_reason() -> Column:
    """Why an enriched row is not fit for the cleaned layer; NULL for a good row."""
    return F.coalesce(
        F.when(F.col("rated_capacity_kwh").isNull(), F.lit("unknown_vehicle")), range_failure()
    )


def assess(bronze: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Enriched raw rows with their ``skip_reason``; one pass feeds rows, rejects and breaker."""
    return enrich(bronze, vehicles).withColumn("skip_reason", skip_reason())


def cleaned_rows(assessed: DataFrame, processed_at: Column | str = "received_at") -> DataFrame:
    """The good rows in the cleaned layer's columns and types."""
    stamp = F.col(processed_at) if isinstance(processed_at, str) else processed_at
    return assessed.where(F.col("skip_reason").isNull()).select(
        F.col("id").alias("bronze_id"), "vehicle_id", "event_timestamp",
        *[F.col(m).cast("double").alias(m) for m in S.MEASURES],
        F.coalesce(F.col("regen_braking_event").cast("int"), F.lit(0)).alias("regen_braking_event"),
        F.col("rated_capacity_kwh").cast("double").alias("rated_capacity_kwh"),
        F.col("manufacture_year").cast("int").alias("manufacture_year"),
        "region", stamp.alias("processed_at"),
    )


def rejected_rows(assessed: DataFrame, processed_at: Column | str = "received_at") -> DataFrame:
    stamp = F.col(processed_at) if isinstance(processed_at, str) else processed_at
    return assessed.where(F.col("skip_reason").isNotNull()).select(
        F.col("id").alias("bronze_id"), "vehicle_id", "event_timestamp", "skip_reason",
        stamp.alias("processed_at"),
    )


def silver(bronze: DataFrame, vehicles: DataFrame, processed_at: Column | str = "received_at") -> DataFrame:
    return cleaned_rows(assess(bronze, vehicles), processed_at)


# --- incremental reading ------------------------------------------------------


def next_batch(bronze: DataFrame, watermark: int, rows: int | None = None) -> DataFrame:
    """The raw rows above the watermark: all of them, or the next ``rows`` in id order."""
    new = bronze.where(F.col("id") > F.lit(watermark))
    return new if rows is None else new.orderBy("id").limit(rows)


def progress(processed: DataFrame, column: str = "bronze_id") -> DataFrame:
    """Highest processed id, 0 when there is none."""
    return processed.agg(F.coalesce(F.max(column), F.lit(0).cast("long")).alias("watermark"))


def with_batch_number(bronze: DataFrame, watermark: int = 0, rows: int = S.BATCH_ROWS) -> DataFrame:
    """Number the batches of a replay: ids (w, w+rows] are batch 0, and so on.

    Fixed id ranges, so no global ordering is needed to tell the batches apart.
    """
    return bronze.where(F.col("id") > F.lit(watermark)).withColumn(
        "batch", F.floor((F.col("id") - F.lit(watermark + 1)) / F.lit(float(rows)))
    )


# --- circuit breaker ----------------------------------------------------------


def failure_summary(threshold: float = S.BREAKER_THRESHOLD) -> list[Column]:
    """Aggregates of a batch: rows read, failed, failure rate, and whether the breaker opens."""
    failed = F.count_if(F.col("skip_reason").isNotNull())
    total = F.count("*")
    rate = F.coalesce(F.try_divide(failed, total), F.lit(0.0))
    opened = rate > F.lit(threshold)
    return [
        total.alias("records_read"), failed.alias("records_failed"), rate.alias("failure_rate"),
        F.when(opened, F.lit(0)).otherwise(total - failed).alias("records_written"),
        opened.alias("circuit_open"),
    ]


def batch_summary(assessed: DataFrame, threshold: float = S.BREAKER_THRESHOLD, by: str | None = "batch") -> DataFrame:
    """Summary of one batch (``by=None``) or of every batch of a replay."""
    grouped = assessed.groupBy(by) if by else assessed.groupBy()
    return grouped.agg(*failure_summary(threshold))


def committed_rows(assessed: DataFrame, threshold: float = S.BREAKER_THRESHOLD, on_trip: str = "halt") -> DataFrame:
    """Assessed rows of the batches that may be written in a replay.

    ``halt``: nothing from the first open batch on, as the batch that trips is retried and
    never passed. ``quarantine``: only the open batches are held back.
    """
    summary = batch_summary(assessed, threshold)
    tripped = summary.where("circuit_open")
    if on_trip == "halt":
        first = tripped.agg(F.min("batch"))
        held = F.coalesce(first.scalar(), F.lit(2**62))
        return assessed.where(F.col("batch") < held)
    if on_trip == "quarantine":
        return assessed.join(tripped.select("batch"), "batch", "left_anti")
    raise ValueError(f"on_trip must be 'halt' or 'quarantine', not {on_trip!r}")


# --- references between layers -----------------------------------------------


def lineage_orphans(silver: DataFrame, bronze: DataFrame) -> DataFrame:
    """Cleaned rows whose raw row does not exist; ids are unique, so no key is hot."""
    return silver.join(bronze.select(F.col("id").alias("bronze_id")), "bronze_id", "left_anti")


def missing_keys(new: DataFrame, existing: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Rows of ``new`` whose key is not in the dimension yet, one per key."""
    return new.join(existing.select(key), key, "left_anti").dropDuplicates([key])
