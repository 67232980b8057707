"""Right to erasure: blank a set of vehicles in every layer, count it, log it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.operators.validation import BLANKS

# what each table loses besides its key
BLANKED = {
    "bronze_telemetry": {"latitude": None, "longitude": None, "raw_payload": S.ERASED},
    "silver_telemetry": {"latitude": None, "longitude": None},
    "silver_rejects": {},
    "silver_late": {"latitude": None, "longitude": None},
    "gold_vehicle_health": {},
    "predictions": {},
    "alerts": {},
}
COUNTED = {
    "bronze_telemetry": "bronze_count", "silver_telemetry": "silver_count",
    "gold_vehicle_health": "gold_count", "predictions": "prediction_count", "alerts": "alert_count",
}


def _requested(keys: DataFrame, key: str) -> DataFrame:
    return keys.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))


def erase(df: DataFrame, keys: DataFrame, table: str, key: str = "vehicle_id") -> DataFrame:
    """The table with the requested keys replaced and their personal columns blanked.

    The left join is on a key list Catalyst broadcasts when it is small; a hot vehicle is
    left to the adaptive skew join otherwise.
    """
    hit = F.coalesce("_hit", F.lit(False))
    blanked = BLANKED[table]

    def column(name: str) -> Column:
        kind = df.schema[name].dataType
        if name == key:
            return F.when(hit, F.lit(S.ERASED)).otherwise(F.col(name)).alias(name)
        if name in blanked:
            return F.when(hit, F.lit(blanked[name]).cast(kind)).otherwise(F.col(name)).alias(name)
        return F.col(name)

    return df.join(_requested(keys, key), key, "left").select(*[column(c) for c in df.columns])


def _named_key(key: str) -> Column:
    """The key that a dead letter's payload names, without the blanks that validation takes off."""
    return F.btrim(F.try_variant_get(F.try_parse_json("raw_payload"), f"$.{key}", "string"), F.lit(BLANKS))


def naming(dlq: DataFrame, keys: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """The dead letters whose payload names a requested key."""
    return dlq.withColumn(key, _named_key(key)).join(keys.select(key), key, "left_semi")


def scrub_dead_letters(dlq: DataFrame, keys: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Blank the payload and reason of dead letters whose payload names a requested key."""
    named = _named_key(key)
    hit = F.coalesce("_hit", F.lit(False))
    joined = dlq.withColumn(key, named).join(_requested(keys, key), key, "left")
    return joined.select(*[
        F.when(hit, F.lit(S.ERASED)).otherwise(F.col(c)).alias(c) if c in ("raw_payload", "error_reason") else F.col(c)
        for c in dlq.columns
    ])


def without_keys(dimension: DataFrame, keys: DataFrame, key: str = "vehicle_id") -> DataFrame:
    return dimension.join(keys.select(key), key, "left_anti").select(*dimension.columns)


def unknown_keys(keys: DataFrame, dimension: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Requested keys that no vehicle has; they change nothing."""
    return keys.select(key).distinct().join(dimension.select(key), key, "left_anti").select(
        key, F.format_string("Vehicle %s not found", F.col(key)).alias("error")
    )


def known_keys(keys: DataFrame, dimension: DataFrame, key: str = "vehicle_id") -> DataFrame:
    return keys.select(key).distinct().join(dimension.select(key), key, "left_semi")


def affected_counts(tables: dict[str, DataFrame], keys: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Per requested key the rows it has in each counted layer, 0 where it has none.

    Each layer is counted per key before anything is shuffled or joined.
    """
    out = keys.select(key).distinct()
    for name, column in COUNTED.items():
        if name in tables:
            hits = tables[name].join(keys.select(key).distinct(), key, "left_semi")
            counts = hits.groupBy(key).agg(F.count("*").alias(column))
            out = out.join(counts, key, "left")
    return out.na.fill(0)


def audit_rows(counts: DataFrame, requested_by: str, erased_at: Column) -> DataFrame:
    """Rows of the erasure log; they keep the key, as the record of what was erased."""
    return counts.select(
        "vehicle_id",
        *[(F.col(c) if c in counts.columns else F.lit(0).cast("bigint")).alias(c) for c in COUNTED.values()],
        F.lit(requested_by).alias("requested_by"), erased_at.alias("erased_at"),
    )
