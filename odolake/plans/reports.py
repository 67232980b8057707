"""Fleet reports. Each takes tables and an ``as_of`` and gives a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.timing import instant, lag_seconds, seconds, stage_status
from odolake.operators.latest import latest_per_key, newest_row, top_n_per_key

Tables = Mapping[str, DataFrame]


def _named(df: DataFrame) -> DataFrame:
    return df.where(F.col("vehicle_id") != S.ERASED)


def _open_alerts(alerts: DataFrame, all_open: bool) -> DataFrame:
    """Open alerts per vehicle: the newest only, or every one of them."""
    rows = alerts.where(F.col("status") == "open").withColumn("alert_score", F.col("anomaly_score"))
    if all_open:
        return rows.select("vehicle_id", "alert_score")
    return newest_row(rows, "vehicle_id", ["created_at", "alert_score"], ["alert_score"])


def _one_row(spark, **values: Column) -> DataFrame:
    return spark.range(1).select(*[v.alias(k) for k, v in values.items()])


def fleet_summary(t: Tables, as_of, online_seconds: float = 120) -> DataFrame:
    """Headline numbers in one row; each number is its own scalar subquery, nothing is cross-joined."""
    now = instant(as_of)
    raw = t["bronze_telemetry"].agg(
        F.struct(
            F.count("*").alias("total"),
            F.max(F.when(F.col("vehicle_id") != S.ERASED, F.col("received_at"))).alias("newest"),
        )
    )
    online = (
        _named(t["bronze_telemetry"]).where(F.col("received_at") >= now - seconds(online_seconds))
        .agg(F.countDistinct("vehicle_id"))
    )
    battery = newest_row(_named(t["gold_vehicle_health"]), "vehicle_id", ["aggregated_at", "window_start"],
                         ["avg_battery_pct"]).agg(F.round(F.avg("avg_battery_pct"), 1))
    open_alerts = _named(t["alerts"]).agg(F.count_if(F.col("status") == "open"))
    one = _one_row(
        t["bronze_telemetry"].sparkSession,
        total_vehicles=t["vehicle_metadata"].agg(F.count("*")).scalar(),
        online_vehicles=online.scalar(),
        active_alerts=open_alerts.scalar(),
        avg_battery_pct=F.coalesce(battery.scalar(), F.lit(0.0)),
        raw=raw.scalar(),
        dlq_depth=t["bronze_dlq"].agg(F.count("*")).scalar(),
        fetched_at=now,
    )
    return one.select(
        "total_vehicles", "online_vehicles", "active_alerts", "avg_battery_pct",
        F.col("raw.newest").alias("latest_event_at"), "dlq_depth", F.col("raw.total").alias("total_events"),
        "fetched_at",
    )


def fleet_vehicles(t: Tables, all_open: bool = False) -> DataFrame:
    """Every vehicle with its newest health row, open alert and newest production score."""
    health = newest_row(
        t["gold_vehicle_health"], "vehicle_id", ["aggregated_at", "window_start"],
        ["avg_battery_pct", "avg_motor_temp_c", "health_score", "rolling_5min_discharge_rate", "aggregated_at"],
    )
    scores = newest_row(
        t["predictions"].where(F.col("mode") == "production").withColumn("latest_pred_score", F.col("anomaly_score")),
        "vehicle_id", ["predicted_at", "window_start"], ["latest_pred_score", "is_anomaly"],
    )
    open_alerts = _open_alerts(t["alerts"], all_open).withColumn("_open", F.lit(1))
    return (
        t["vehicle_metadata"]
        .select("vehicle_id", "fleet_label", "make", "model", "manufacture_year", "software_version")
        .join(health, "vehicle_id", "left")
        .join(open_alerts, "vehicle_id", "left")
        .join(scores, "vehicle_id", "left")
        .withColumn("has_alert", F.coalesce("_open", F.lit(0)))
        .withColumnRenamed("alert_score", "anomaly_score")
        .drop("_open")
        .orderBy(F.desc("has_alert"), F.asc_nulls_first("health_score"), "vehicle_id")
    )


def vehicle_metadata(t: Tables, vehicle_id: str) -> DataFrame:
    return t["vehicle_metadata"].where(F.col("vehicle_id") == F.lit(vehicle_id))


def vehicle_telemetry(t: Tables, vehicle_id: str, as_of, span_seconds: float = 3600) -> DataFrame:
    return (
        t["silver_telemetry"]
        .where((F.col("vehicle_id") == F.lit(vehicle_id))
               & (F.col("event_timestamp") >= instant(as_of) - seconds(span_seconds)))
        .select("event_timestamp", "battery_pct", "voltage_v", "motor_temp_c", "current_a", "speed_kmh",
                "regen_braking_event")
        .orderBy("event_timestamp")
    )


_HEALTH = ("window_start", "avg_battery_pct", "avg_motor_temp_c", "health_score", "rolling_5min_discharge_rate")
_PREDICTION = ("window_start", "anomaly_score", "is_anomaly", "mode", "predicted_at")
_ALERT = ("first_detected_at", "anomaly_score", "top_features", "status", "created_at")


def health_history(gold: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` health rows of every vehicle."""
    rows = top_n_per_key(_named(gold), "vehicle_id", [F.desc("aggregated_at"), F.desc("window_start")], n)
    return rows.select("vehicle_id", *_HEALTH)


def prediction_history(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The newest ``n`` predictions of every vehicle, of either mode."""
    rows = top_n_per_key(_named(predictions), "vehicle_id", [F.desc("predicted_at"), "mode", F.desc("window_start")], n)
    return rows.select("vehicle_id", *_PREDICTION)


def alert_history(alerts: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` alerts of every vehicle."""
    rows = top_n_per_key(_named(alerts), "vehicle_id", [F.desc("created_at"), F.desc("first_detected_at")], n)
    return rows.select("vehicle_id", *_ALERT)


def vehicle_detail(t: Tables, vehicle_id: str, as_of, span_seconds: float = 3600) -> dict[str, DataFrame]:
    """The five frames of one vehicle; the key filter reaches the scans."""
    def mine(name: str) -> DataFrame:
        return t[name].where(F.col("vehicle_id") == F.lit(vehicle_id))

    return {
        "metadata": vehicle_metadata(t, vehicle_id),
        "telemetry": vehicle_telemetry(t, vehicle_id, as_of, span_seconds),
        "gold_history": mine("gold_vehicle_health").orderBy(F.desc("aggregated_at")).limit(20).select(*_HEALTH),
        "predictions": mine("predictions").orderBy(F.desc("predicted_at"), "mode").limit(20).select(*_PREDICTION),
        "alerts": mine("alerts").orderBy(F.desc("created_at")).limit(10).select(*_ALERT),
    }


def newest_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    """The newest alerts with the feature list as JSON text."""
    newest = _named(alerts).orderBy(F.desc("created_at"), "vehicle_id", F.desc("first_detected_at")).limit(limit)
    return newest.withColumn("top_features", F.to_json("top_features"))


def alert_list(alerts: DataFrame) -> DataFrame:
    """All alerts with the feature list as JSON text."""
    return _named(alerts).select(
        "vehicle_id", "anomaly_score", F.to_json("top_features").alias("top_features"), "status", "created_at")


_STAGES = (
    ("ingestion", "bronze_telemetry", "received_at"),
    ("silver", "silver_telemetry", "processed_at"),
    ("gold", "gold_vehicle_health", "aggregated_at"),
    ("prediction", "predictions", "predicted_at"),
)


def stage_health(t: Tables, as_of, interval_seconds: float = 30) -> DataFrame:
    """Per stage: status, newest output, age in seconds. Stale from twice the interval on."""
    now = instant(as_of)
    parts = None
    for stage, name, column in _STAGES:
        rows = t[name].where(F.col("mode") == "production") if name == "predictions" else t[name]
        part = rows.agg(F.max(column).alias("last_run")).select(F.lit(stage).alias("stage"), "last_run")
        parts = part if parts is None else parts.unionByName(part)
    return parts.select(
        "stage", stage_status(F.col("last_run"), now, 2 * interval_seconds).alias("status"), "last_run",
        lag_seconds(F.col("last_run"), now).alias("lag_seconds"),
    )


def stage_counts(t: Tables) -> DataFrame:
    """(layer, records) for six tables; alerts count while open."""
    layers = {
        "bronze": t["bronze_telemetry"], "silver": t["silver_telemetry"], "gold": t["gold_vehicle_health"],
        "dlq": t["bronze_dlq"], "predictions": t["predictions"],
        "alerts": t["alerts"].where(F.col("status") == "open"),
    }
    out = None
    for layer, df in layers.items():
        part = df.agg(F.count("*").alias("records")).select(F.lit(layer).alias("layer"), "records")
        out = part if out is None else out.unionByName(part)
    return out


def layer_counts(t: Tables) -> DataFrame:
    """One row with the size of each layer."""
    def size(name: str) -> Column:
        return t[name].agg(F.count("*")).scalar()

    return _one_row(
        t["bronze_telemetry"].sparkSession, bronze=size("bronze_telemetry"), silver=size("silver_telemetry"),
        gold=size("gold_vehicle_health"), dlq=size("bronze_dlq"),
    )


def fleet_positions(t: Tables, all_open: bool = False) -> DataFrame:
    """Newest cleaned reading of every known vehicle, with software version and alert flag."""
    newest = latest_per_key(_named(t["silver_telemetry"]), "vehicle_id", "event_timestamp")
    open_alerts = _open_alerts(t["alerts"], all_open).select("vehicle_id", F.lit(1).alias("_open"))
    return (
        newest.join(t["vehicle_metadata"].select("vehicle_id", "software_version", "fleet_label"), "vehicle_id")
        .join(open_alerts, "vehicle_id", "left")
        .select("vehicle_id", "latitude", "longitude", "event_timestamp", "battery_pct", "motor_temp_c",
                "speed_kmh", "software_version", "fleet_label", F.coalesce("_open", F.lit(0)).alias("has_alert"))
    )


def latest_scores(predictions: DataFrame) -> DataFrame:
    """Newest production score per vehicle, worst first."""
    rows = newest_row(_named(predictions).where(F.col("mode") == "production"), "vehicle_id",
                      ["predicted_at", "window_start"], ["anomaly_score", "is_anomaly"])
    return rows.orderBy("anomaly_score", "vehicle_id")
