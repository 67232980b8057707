"""Table schemas, field rules and default parameters of the telemetry lake.

Every operator takes its bounds, windows and thresholds as arguments; the values
here are only the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ERASED = "[ERASED]"

# --- fixed values: accepted fields, in checking order, with inclusive bounds ---


@dataclass(frozen=True)
class FieldRule:
    """One expected payload field; ``kind`` is ``string``, ``double`` or ``boolean``."""

    name: str
    kind: str
    low: float | None = None
    high: float | None = None
    required: bool = True


TELEMETRY_RULES = (
    FieldRule("vehicle_id", "string"),
    FieldRule("event_timestamp", "string"),
    FieldRule("battery_pct", "double", 0.0, 100.0),
    FieldRule("state_of_charge_kwh", "double", 0.0, 150.0),
    FieldRule("voltage_v", "double", 0.0, 1000.0),
    FieldRule("current_a", "double", -500.0, 500.0),
    FieldRule("motor_temp_c", "double", -40.0, 180.0),
    FieldRule("latitude", "double", -90.0, 90.0),
    FieldRule("longitude", "double", -180.0, 180.0),
    FieldRule("speed_kmh", "double", 0.0, 250.0),
    FieldRule("regen_braking_event", "boolean"),
)

NUMERIC_RULES = tuple(r for r in TELEMETRY_RULES if r.kind == "double")
MEASURES = tuple(r.name for r in NUMERIC_RULES)

FEATURES = (
    "avg_battery_pct",
    "avg_voltage_v",
    "avg_current_a",
    "avg_motor_temp_c",
    "rolling_5min_discharge_rate",
)

VEHICLE_ID_PATTERN = r"^VF-[0-9]{3}\z"
VEHICLE_ID_FORMAT_HINT = "VF-NNN"
MAX_PAYLOAD_BYTES = 4096
MAX_FUTURE_SECONDS = 60
BREAKER_THRESHOLD = 0.10
BATCH_ROWS = 1000
CONTAMINATION = 0.05
MODEL_VERSION = "v1.0"

# --- table schemas -----------------------------------------------------------


_TYPES = {
    "STRING": T.StringType(), "DOUBLE": T.DoubleType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "BOOLEAN": T.BooleanType(), "TIMESTAMP": T.TimestampType(), "STRINGS": T.ArrayType(T.StringType()),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name TYPE, ...``; works before any session exists."""
    pairs = (part.split() for part in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


VEHICLE_METADATA = _struct(
    "vehicle_id STRING, fleet_label STRING, make STRING, model STRING, manufacture_year INT, "
    "rated_capacity_kwh DOUBLE, region STRING, registered_at TIMESTAMP, software_version STRING"
)

_READINGS = ", ".join(f"{m} DOUBLE" for m in MEASURES)

BRONZE = _struct(
    "id BIGINT, vehicle_id STRING, event_timestamp TIMESTAMP, received_at TIMESTAMP, "
    f"{_READINGS}, regen_braking_event BOOLEAN, raw_payload STRING"
)

DLQ = _struct(
    "id BIGINT, received_at TIMESTAMP, raw_payload STRING, error_reason STRING, client_ip STRING"
)

# Latitude and longitude stay nullable so that an erasure can blank them.
SILVER = _struct(
    "bronze_id BIGINT, vehicle_id STRING, event_timestamp TIMESTAMP, "
    f"{_READINGS}, regen_braking_event INT, rated_capacity_kwh DOUBLE, "
    "manufacture_year INT, region STRING, processed_at TIMESTAMP"
)

SILVER_REJECTS = _struct(
    "bronze_id BIGINT, vehicle_id STRING, event_timestamp TIMESTAMP, skip_reason STRING, "
    "processed_at TIMESTAMP"
)

# cleaned rows that came after their window had been closed
SILVER_LATE = SILVER

GOLD = _struct(
    "vehicle_id STRING, window_start TIMESTAMP, window_end TIMESTAMP, avg_battery_pct DOUBLE, "
    "avg_voltage_v DOUBLE, avg_current_a DOUBLE, avg_motor_temp_c DOUBLE, avg_speed_kmh DOUBLE, "
    "rolling_5min_discharge_rate DOUBLE, health_score DOUBLE, record_count BIGINT, "
    "aggregated_at TIMESTAMP"
)

PREDICTIONS = _struct(
    "vehicle_id STRING, window_start TIMESTAMP, anomaly_score DOUBLE, is_anomaly BOOLEAN, "
    "model_version STRING, mode STRING, predicted_at TIMESTAMP"
)

ALERTS = _struct(
    "id BIGINT, vehicle_id STRING, first_detected_at TIMESTAMP, run_started_at TIMESTAMP, "
    "anomaly_score DOUBLE, top_features STRINGS, status STRING, acknowledged_at TIMESTAMP, "
    "acknowledged_by STRING, created_at TIMESTAMP"
)

ERASURE_LOG = _struct(
    "vehicle_id STRING, bronze_count BIGINT, silver_count BIGINT, gold_count BIGINT, "
    "prediction_count BIGINT, alert_count BIGINT, requested_by STRING, erased_at TIMESTAMP"
)

# table name -> key, of tables where a row of a later batch supersedes those of the same key
SUPERSEDED_BY = {"gold_vehicle_health": ("vehicle_id", "window_start")}

# table name -> (schema, time column whose date partitions the table, if any)
TABLES = {
    "vehicle_metadata": (VEHICLE_METADATA, None),
    "bronze_telemetry": (BRONZE, "received_at"),
    "bronze_dlq": (DLQ, "received_at"),
    "silver_telemetry": (SILVER, "event_timestamp"),
    "silver_rejects": (SILVER_REJECTS, "processed_at"),
    "silver_late": (SILVER_LATE, "event_timestamp"),
    "gold_vehicle_health": (GOLD, "window_start"),
    "predictions": (PREDICTIONS, "predicted_at"),
    "alerts": (ALERTS, "created_at"),
    "erasure_log": (ERASURE_LOG, None),
}
