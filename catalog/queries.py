"""Catalogue of runnable queries: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import lake as L
from catalog.lake import Lake, plain
from odolake import schemas as S
from odolake.functions.numeric import round_half_even
from odolake.operators import (
    alerting, cleaning, drift, erasure, forest, governance, health, ingest, latest, quantile, rate_limit, sketches, validation,
)
from odolake.plans import cycle, reports
from odolake.session import staging_path
from odolake.sources.latest_table import LatestTable
from odolake.sources.store import Store
from catalog import telemetry
from odolake.streaming import jobs, stateful
from odolake.streaming.panes import CarriedPanes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BUILDS: dict[str, Callable[[Lake], DataFrame]] = {}


def query(build: Callable[[Lake], DataFrame]) -> Callable[[Lake], DataFrame]:
    """Register ``build`` under its own name."""
    BUILDS[build.__name__] = build
    QUERIES[build.__name__] = lambda spark, sf_dir: plain(build(Lake(spark, sf_dir)))
    return build


# --- validation and routing ---------------------------------------------------

@query
def v_validate_events(t: Lake) -> DataFrame:
    typed = [c.name for c in S.TELEMETRY_RULES]
    ok = F.col("reason").isNull()
    return t.inspected.select(
        "id", F.coalesce("reason", F.lit("ok")).alias("reason"), *[F.when(ok, F.col(c)).alias(c) for c in typed]
    )


@query
def v_reason_counts(t: Lake) -> DataFrame:
    cls = F.coalesce(validation.reason_class(F.col("reason")), F.lit("ok"))
    return t.inspected.groupBy(cls.alias("reason_class")).agg(F.count("*").alias("events"))


@query
def p1_route_accepted(t: Lake) -> DataFrame:
    return ingest.accepted_rows(t.routed).select("id", "vehicle_id", "event_timestamp", "battery_pct", "raw_payload")


@query
def p1_route_dlq(t: Lake) -> DataFrame:
    return t.dlq.select("id", "received_at", "raw_payload", "error_reason", "client_ip")


@query
def d6_dlq_preview(t: Lake) -> DataFrame:
    return ingest.dlq_newest(t.dlq)


@query
def d8_ingest_metrics(t: Lake) -> DataFrame:
    return ingest.ingest_metrics(t.limited)


@query
def d8_outcome_counts(t: Lake) -> DataFrame:
    return ingest.outcome_counts(t.limited)


@query
def x7_events_per_minute(t: Lake) -> DataFrame:
    return ingest.events_per_minute(t.bronze)


# --- rate limiting ------------------------------------------------------------

@query
def r1_token_bucket(t: Lake) -> DataFrame:
    return rate_limit.token_bucket(t.bronze, refill_per_second=L.REFILL)


# --- cleaning -----------------------------------------------------------------

@query
def s4_incremental_batch(t: Lake) -> DataFrame:
    batch = cleaning.next_batch(t.bronze, watermark=500, rows=1000)
    return batch.select("id", "vehicle_id", "event_timestamp", "battery_pct")


@query
def s13_progress(t: Lake) -> DataFrame:
    return cleaning.progress(t.silver)


@query
def j1_enrich(t: Lake) -> DataFrame:
    return cleaning.enrich(t.bronze, t.vehicles).select(
        "id", "vehicle_id", "rated_capacity_kwh", F.coalesce("region", F.lit("none")).alias("region")
    )


@query
def p2_silver_clean(t: Lake) -> DataFrame:
    return t.silver


@query
def p4_silver_rejects(t: Lake) -> DataFrame:
    return cleaning.rejected_rows(t.assessed)


@query
def p4_reject_counts(t: Lake) -> DataFrame:
    return t.assessed.groupBy(F.coalesce("skip_reason", F.lit("ok")).alias("skip_reason")).agg(
        F.count("*").alias("records"))


def _batches(t: Lake, faulty: bool) -> DataFrame:
    """Assessed raw rows by batch; ``faulty`` readings lose four times the charge."""
    bronze = t.bronze
    if faulty:
        bronze = bronze.withColumn("battery_pct", F.lit(100.0) - (F.lit(100.0) - F.col("battery_pct")) * F.lit(4.0))
    return cleaning.assess(cleaning.with_batch_number(bronze), t.vehicles)


@query
def r5_circuit_breaker_closed(t: Lake) -> DataFrame:
    return cleaning.batch_summary(_batches(t, False)).withColumn("failure_rate", F.round("failure_rate", 6))


@query
def r5_circuit_breaker_open(t: Lake) -> DataFrame:
    return cleaning.batch_summary(_batches(t, True)).withColumn("failure_rate", F.round("failure_rate", 6))


@query
def r5_committed_halt(t: Lake) -> DataFrame:
    rows = cleaning.committed_rows(_batches(t, False), threshold=0.02)
    return rows.where(F.col("skip_reason").isNull()).agg(
        F.count("*").alias("written"), F.coalesce(F.max("id"), F.lit(0)).alias("watermark"))


@query
def r5_committed_quarantine(t: Lake) -> DataFrame:
    rows = cleaning.committed_rows(_batches(t, False), threshold=0.02, on_trip="quarantine")
    return rows.where(F.col("skip_reason").isNull()).agg(
        F.count("*").alias("written"), F.coalesce(F.max("id"), F.lit(0)).alias("watermark"))


@query
def a11_failure_rate(t: Lake) -> DataFrame:
    return cleaning.batch_summary(t.assessed, by=None).withColumn("failure_rate", F.round("failure_rate", 6))


@query
def s12_seed_missing_keys(t: Lake) -> DataFrame:
    seen = t.bronze.select("vehicle_id")
    return cleaning.missing_keys(seen, t.vehicles)


@query
def j10_lineage_orphans(t: Lake) -> DataFrame:
    accepted = ingest.accepted_rows(t.routed)
    return cleaning.lineage_orphans(t.silver, accepted).select("bronze_id", "vehicle_id")


# --- health aggregates --------------------------------------------------------

@query
def g_gold_snapshot(t: Lake) -> DataFrame:
    return health.gold_snapshot(t.silver, L.AS_OF, L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES)


@query
def w2_gold_sliding(t: Lake) -> DataFrame:
    return t.gold


@query
def a1_window_means(t: Lake) -> DataFrame:
    return health.gold_snapshot(t.silver, L.AS_OF, L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES).select(
        "vehicle_id", *[f"avg_{m}" for m in health.AVERAGED], "record_count")


@query
def a4_discharge_rate(t: Lake) -> DataFrame:
    return health.gold_snapshot(t.silver, L.AS_OF, L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES).select(
        "vehicle_id", F.col("rolling_5min_discharge_rate").alias("discharge_rate"))


@query
def w3_rolling_rate(t: Lake) -> DataFrame:
    rows = health.rolling_rate(t.silver, L.LOOKBACK, L.UNIT_MINUTES)
    return rows.withColumn("discharge_rate", F.round("discharge_rate", 6))


@query
def f1_health_score(t: Lake) -> DataFrame:
    """The score of every single reading, with its own charge lost per hundred as the rate."""
    score = health.health_score(F.col("battery_pct"), F.col("motor_temp_c"), F.col("voltage_v"),
                                (F.lit(100.0) - F.col("battery_pct")) / F.lit(20.0))
    return t.silver.select("bronze_id", round_half_even(score, 4).alias("health_score"))


# --- newest rows --------------------------------------------------------------

@query
def j2_latest_per_key(t: Lake) -> DataFrame:
    rows = latest.latest_per_key(t.silver, "vehicle_id", "event_timestamp")
    return rows.select("vehicle_id", "bronze_id", "event_timestamp", "battery_pct")


@query
def a16_latest_score(t: Lake) -> DataFrame:
    return reports.latest_scores(t.predictions)


@query
def u1_predictions_union(t: Lake) -> DataFrame:
    return t.predictions.drop("model_version")


# --- reports ------------------------------------------------------------------

@query
def d1_fleet_summary(t: Lake) -> DataFrame:
    return reports.fleet_summary(t.tables, L.AS_OF, L.ONLINE)


@query
def d2_fleet_vehicles(t: Lake) -> DataFrame:
    return reports.fleet_vehicles(t.tables)


@query
def d2_fleet_vehicles_all_alerts(t: Lake) -> DataFrame:
    return reports.fleet_vehicles(t.tables, all_open=True).select("vehicle_id", "has_alert", "anomaly_score")


@query
def d3_metadata(t: Lake) -> DataFrame:
    return reports.vehicle_metadata(t.tables, "VF-001")


@query
def d3_telemetry(t: Lake) -> DataFrame:
    return reports.vehicle_telemetry(t.tables, "VF-001", L.AS_OF, 10 * L.DAY)


@query
def d3_gold_topn(t: Lake) -> DataFrame:
    return reports.health_history(t.gold)


@query
def d3_predictions_topn(t: Lake) -> DataFrame:
    return reports.prediction_history(t.predictions)


@query
def d3_alerts_topn(t: Lake) -> DataFrame:
    return reports.alert_history(t.alerts)


@query
def d4_alerts(t: Lake) -> DataFrame:
    return reports.newest_alerts(t.alerts)


@query
def d5_stage_health(t: Lake) -> DataFrame:
    return reports.stage_health(t.tables, L.AS_OF, interval_seconds=600)


@query
def d5_counts(t: Lake) -> DataFrame:
    return reports.stage_counts(t.tables)


@query
def d7_positions(t: Lake) -> DataFrame:
    return reports.fleet_positions(t.tables)


@query
def d9_layer_counts(t: Lake) -> DataFrame:
    return reports.layer_counts(t.tables)


@query
def d11_alert_list(t: Lake) -> DataFrame:
    return reports.alert_list(t.alerts)


# --- outlier model ------------------------------------------------------------

@query
def m2_scaler(t: Lake) -> DataFrame:
    row = forest.scaler(t.gold)
    return row.select("rows_read", "rows_complete",
                      *[F.round(c, 6).alias(c) for c in row.columns if c.startswith(("mean_", "dev_"))])


@query
def a13_threshold(t: Lake) -> DataFrame:
    """Distributed exact quantile of the health scores, told as a one-row frame."""
    value = quantile.exact_quantile(t.stored_gold, "health_score", S.CONTAMINATION, bins=64, enough=16)
    return t.spark.range(1).select(F.round(F.lit(value), 6).alias("threshold"))


@query
def m8_top_features(t: Lake) -> DataFrame:
    return alerting.top_features(t.stored_gold)


def _fit(t: Lake, seed: int = 42) -> forest.Forest:
    return forest.fit_forest(t.stored_gold, L.AS_OF, seed=seed)


@query
def m3_forest_nodes(t: Lake) -> DataFrame:
    return t.spark.createDataFrame(_fit(t).nodes, forest.NODES)


@query
def m3_forest_shape(t: Lake) -> DataFrame:
    """What must hold for every tree: the root holds the sample, the leaves share it out, the depth is bounded."""
    leaf = F.col("feature") < 0
    tree = m3_forest_nodes(t).groupBy("tree").agg(
        F.max(F.when(F.col("depth") == 0, F.col("size"))).alias("root"), F.sum(F.when(leaf, F.col("size"))).alias("leaves"),
        F.max("depth").alias("deepest"))
    return tree.agg(
        F.count("*").alias("trees"), F.min("root").alias("smallest_root"), F.max("root").alias("largest_root"),
        F.min("leaves").alias("fewest_in_leaves"), F.max("leaves").alias("most_in_leaves"),
        (F.max("deepest") <= F.ceil(F.log2(F.max("root")))).alias("depth_bounded"))


@query
def m5_labels(t: Lake) -> DataFrame:
    """Every row has a score, a label that follows its sign, and about the contamination's share is flagged."""
    rows = m4_scores(t)
    flagged = F.count_if("is_anomaly") / F.count("*")
    return rows.agg(
        F.count("*").alias("rows"), F.count("anomaly_score").alias("scored"),
        F.count_if((F.col("anomaly_score") < 0) & ~F.col("is_anomaly")).alias("wrong_labels"),
        (F.abs(flagged - S.CONTAMINATION) < 0.01).alias("share_holds"))


@query
def m7_rows_per_mode(t: Lake) -> DataFrame:
    return m7_shadow_union(t).groupBy("mode").agg(
        F.count("*").alias("rows"), F.countDistinct("vehicle_id").alias("vehicles"))


@query
def m4_scores(t: Lake) -> DataFrame:
    return forest.score(t.stored_gold, _fit(t)).select("vehicle_id", "window_start", "anomaly_score", "is_anomaly")


@query
def m7_shadow_union(t: Lake) -> DataFrame:
    newest = latest.latest_per_key(t.stored_gold, "vehicle_id", "aggregated_at")
    live = forest.predictions(newest, _fit(t), "production", L.AS_OF)
    return live.unionByName(forest.predictions(newest, _fit(t, seed=99), "shadow", L.AS_OF))


# --- alerts -------------------------------------------------------------------

@query
def w5_consecutive(t: Lake) -> DataFrame:
    return alerting.consecutive_windows(t.predictions).select(
        "vehicle_id", "window_start", "is_anomaly", "confirmed", "run_started_at")


@query
def w6_suppressed_alerts(t: Lake) -> DataFrame:
    return t.alerts


@query
def m10_cycle_alerts(t: Lake) -> DataFrame:
    """Alerts of the last day's cycle, given the predictions so far and the earlier alerts."""
    earlier = t.alerts.where(F.col("created_at") < F.lit(L.AS_OF).cast("timestamp")).withColumn(
        "id", F.unix_micros("created_at"))
    new = alerting.raise_alerts(t.predictions, earlier, t.stored_gold, L.AS_OF, 2, L.QUIET_HOURS, 1.2)
    return new.select("vehicle_id", "first_detected_at", "anomaly_score", "top_features", "created_at")


# --- erasure ------------------------------------------------------------------

def _requests(t: Lake) -> DataFrame:
    """Vehicles with software at its end of life ask for erasure, and so do all unregistered ones."""
    old = t.vehicles.where(F.col("software_version") == "4.1").select("vehicle_id")
    return old.unionByName(cleaning.missing_keys(t.bronze.select("vehicle_id"), t.vehicles))


def _known(t: Lake) -> DataFrame:
    return erasure.known_keys(_requests(t), t.vehicles)


@query
def e1_erase_bronze(t: Lake) -> DataFrame:
    bronze = t.bronze.withColumn("raw_payload", F.col("vehicle_id"))
    return erasure.erase(bronze, _known(t), "bronze_telemetry").select(
        "id", "vehicle_id", "latitude", "longitude", "raw_payload", "battery_pct")


@query
def e1_erase_silver(t: Lake) -> DataFrame:
    return erasure.erase(t.silver, _known(t), "silver_telemetry").select(
        "bronze_id", "vehicle_id", "latitude", "longitude", "battery_pct")


@query
def e2_metadata_after(t: Lake) -> DataFrame:
    return erasure.without_keys(t.vehicles, _known(t))


@query
def e3_erasure_counts(t: Lake) -> DataFrame:
    layers = {k: v for k, v in t.tables.items() if k in erasure.COUNTED}
    return erasure.affected_counts(layers, _known(t))


@query
def e4_unknown_keys(t: Lake) -> DataFrame:
    return erasure.unknown_keys(_requests(t), t.vehicles)


# --- written requirements -----------------------------------------------------

@query
def x1_retention(t: Lake) -> DataFrame:
    kept = governance.retained(t.bronze, "received_at", L.AS_OF, "10 DAYS")
    return kept.select("id", "received_at")


@query
def x2_pseudonymise(t: Lake) -> DataFrame:
    return governance.pseudonymised(t.silver, "pepper").select("bronze_id", "vehicle_id")


@query
def x3_k_anonymous_region(t: Lake) -> DataFrame:
    return governance.anonymous_by_group(t.gold, t.vehicles)


@query
def x4_operational_alarms(t: Lake) -> DataFrame:
    tables = t.tables
    return governance.operational_alarms(t.dlq, reports.stage_health(tables, L.AS_OF, 600))


# --- sketches and drift -------------------------------------------------------

@query
def a6_approx_distinct(t: Lake) -> DataFrame:
    """Vehicles per week from daily sketches, held against the exact count: an error of five percent at most."""
    week = F.date_trunc("week", F.col("day").cast("timestamp")).alias("week")
    about = sketches.distinct_vehicles(sketches.daily_vehicles(t.bronze), week)
    exact = t.bronze.groupBy(F.date_trunc("week", "received_at").alias("week")).agg(F.countDistinct("vehicle_id").alias("exact"))
    return about.join(exact, "week").select(
        "week", "exact", (F.abs(F.col("vehicles") - F.col("exact")) <= F.col("exact") * 0.05 + 1).alias("holds"))


SHARES = [0.01, S.CONTAMINATION, 0.5, 0.95]


@query
def a13_sketch_threshold(t: Lake) -> DataFrame:
    """Quantiles of the health score from daily sketches: each holds its rank within half a percent."""
    found = sketches.merged_quantiles(sketches.daily_values(t.stored_gold, "health_score", "window_start"), SHARES)
    rows = None
    for share, value in zip(SHARES, found):
        below, upto = F.avg((F.col("health_score") < value).cast("double")), F.avg((F.col("health_score") <= value).cast("double"))
        one = t.stored_gold.agg(F.lit(share).alias("share"), F.count("*").alias("rows"),
                                ((below <= share + 0.005) & (upto >= share - 0.005)).alias("holds"))
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def x6_score_drift(t: Lake) -> DataFrame:
    """Distance of each day's health scores from those of the first ten days, and whether it asks for a new model."""
    far = drift.daily_distance(t.stored_gold, "health_score", "window_start", F.lit("2024-01-11").cast("timestamp"), 0.0, 5.0, 20)
    return far.select(F.col("day").cast("string").alias("day"), "rows", F.round(F.col("distance") + 1e-9, 6).alias("distance"),
                      (F.col("distance") > 0.1).alias("due"))


# --- the same operators as streams --------------------------------------------

def _drained(t: Lake, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything there is into Parquet files of the shared folder."""
    out, mark = staging_path(t.spark, label), staging_path(t.spark, f"{label}-checkpoint")
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(out)


def _live(t: Lake) -> DataFrame:
    return telemetry.readings(telemetry.event_stream(t.spark, t.sf_dir))


@query
def stream_route(t: Lake) -> DataFrame:
    checked = validation.inspect(telemetry.raw_events(_live(t))).withColumn("outcome", ingest.outcome())
    return _drained(t, checked.select("id", "outcome", F.coalesce("reason", F.lit("ok")).alias("reason")), "route")


@query
def stream_silver(t: Lake) -> DataFrame:
    return _drained(t, cleaning.silver(_live(t), t.vehicles), "silver")


@query
def stream_gold(t: Lake) -> DataFrame:
    """Windows closed by the watermark, one day behind the newest reading at most."""
    silver = cleaning.silver(_live(t), t.vehicles)
    return _drained(t, jobs.gold_stream(silver, L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES, "10 minutes"), "gold")


@query
def stream_token_bucket(t: Lake) -> DataFrame:
    return _drained(t, stateful.limit_stream(_live(t), refill_per_second=L.REFILL), "limiter")


FILES = 4  # micro-batches of the streams below


def _in_batches(t: Lake, rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rows`` as a stream of several micro-batches in the given order."""
    path = telemetry.in_order(rows, staging_path(t.spark, label), order, FILES)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query
def stream_gate(t: Lake) -> DataFrame:
    """The limiter of the streamed ingest, its buckets carried over several micro-batches."""
    events = _in_batches(t, t.bronze.select("id", "vehicle_id", "received_at"), ["received_at", "id"], "arrivals")
    out, mark = staging_path(t.spark, "gate"), staging_path(t.spark, "gate-checkpoint")
    jobs.limit_query(events, out, mark, None, refill_per_second=L.REFILL).awaitTermination()
    return t.spark.read.parquet(f"{out}/batch=*")


def _ingested(t: Lake) -> Store:
    """A store filled by the streamed ingest: limiter, validation, raw rows and dead letters."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    raw = _in_batches(t, t.raw, ["received_at", "id"], "raw").drop("id")
    jobs.ingest_query(raw, store, staging_path(t.spark, "ingest"), None, refill_per_second=L.REFILL).awaitTermination()
    return store


@query
def s2_bronze_append(t: Lake) -> DataFrame:
    return _ingested(t).read("bronze_telemetry").select(
        "vehicle_id", "event_timestamp", "received_at", "battery_pct", "raw_payload")


@query
def s3_dlq_append(t: Lake) -> DataFrame:
    return _ingested(t).read("bronze_dlq").drop("id")


def _cleaned(t: Lake) -> Store:
    """A store with the readings as raw rows in two batches, each cleaned by a cycle's first stage."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    store.seed_vehicles(t.vehicles, 0)
    for n, part in enumerate((F.col("id") % 3 == 0, F.col("id") % 3 > 0)):
        # ids grow with the batches, as ids of a stream do
        rows = t.bronze.where(part).withColumn("id", F.col("id") + F.lit(n << 40)).withColumn("raw_payload", F.col("vehicle_id"))
        store.write_batch("bronze_telemetry", rows, n)
        cycle.clean_batch(store, n, datetime.fromisoformat(L.AS_OF), threshold=1.0)
    return store


def _own_id() -> Column:
    return F.col("bronze_id").bitwiseAND(F.lit((1 << 40) - 1)).alias("bronze_id")


@query
def s5_silver_batch(t: Lake) -> DataFrame:
    return _cleaned(t).read("silver_telemetry").select(
        _own_id(), "vehicle_id", "event_timestamp", *S.MEASURES, "regen_braking_event", "region", "processed_at")


@query
def s7_gold_append(t: Lake) -> DataFrame:
    """The health rows a cycle appends: the snapshot, and the earlier windows that the batch fell into."""
    store = _cleaned(t)
    as_of = datetime.fromisoformat(L.AS_OF)
    cycle.aggregate_batch(store, 2, as_of, L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES, cleaned=(0, 1))
    return store.read("gold_vehicle_health").select(*_EXACT)


EARLIER = "2024-01-20 07:00:00"  # off the time grid


@query
def s7_gold_superseded(t: Lake) -> DataFrame:
    """Current health rows after two cycles, the second with readings that come late into windows of the first."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    first = (F.col("bronze_id") % 3 == 0) & (F.col("event_timestamp") < F.lit(EARLIER).cast("timestamp"))
    for n, (part, as_of) in enumerate(((first, EARLIER), (~first, L.AS_OF))):
        store.write_batch("silver_telemetry", t.silver.where(part), n)
        cycle.aggregate_batch(store, n, datetime.fromisoformat(as_of), L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES)
    return store.current("gold_vehicle_health").select(*_EXACT)


def _cycled(t: Lake) -> tuple[Store, dict]:
    """A store after one whole cycle over all readings, and the cycle's summary."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    store.seed_vehicles(t.vehicles, 0)
    store.write_batch("bronze_telemetry", t.bronze.withColumn("raw_payload", F.col("vehicle_id")), 0)
    shape = {"window_seconds": L.WINDOW, "lookback_seconds": L.LOOKBACK, "unit_minutes": L.UNIT_MINUTES}
    return store, cycle.run_cycle(store, 0, datetime.fromisoformat(L.AS_OF), gold=shape,
                                  alert={"suppression_hours": L.QUIET_HOURS})


@query
def m6_newest_scored(t: Lake) -> DataFrame:
    """What a cycle predicts: the newest health row of every vehicle, by both models, labelled by the sign of its score."""
    score, bad = F.col("anomaly_score"), F.col("is_anomaly")
    return _cycled(t)[0].read("predictions").select(
        "vehicle_id", "window_start", "mode", "model_version", "predicted_at",
        score.between(-1, 1).alias("scored"), (F.when(score < 0, bad).when(score > 0, ~bad).otherwise(True)).alias("labelled"))


@query
def m9_cycle(t: Lake) -> DataFrame:
    """One row on a whole cycle: what each stage read and wrote, and whether its summary agrees with the store."""
    store, summary = _cycled(t)
    stored = store.read("predictions")
    flagged = stored.where("is_anomaly AND mode = 'production'")
    # a vehicle has one prediction yet, so none has a run of two
    counts = {
        "errors": len(summary["errors"]), "circuit_open": int(summary["circuit_open"]),
        **{name: summary[name] for name in ("records_read", "records_written", "records_failed", "watermark")},
        "gold_rows": store.read("gold_vehicle_health").count(), "predictions_written": summary["predictions_written"],
        "counts_agree": int(stored.count() == summary["predictions_written"] and flagged.count() == summary["anomalies_detected"]),
        "alerts_raised": summary["alerts_raised"],
    }
    return t.spark.range(1).select(*[F.lit(v).cast("bigint").alias(name) for name, v in counts.items()])


@query
def s9_alert_append(t: Lake) -> DataFrame:
    """The alerts a store's cycle appends, given stored predictions, health rows and earlier alerts."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    store.write_batch("gold_vehicle_health", t.stored_gold, 0)
    store.write_batch("predictions", t.predictions, 0)
    earlier = t.alerts.where(F.col("created_at") < F.lit(L.AS_OF).cast("timestamp"))
    store.write_batch("alerts", earlier.withColumn("id", F.unix_micros("created_at")), 0)
    cycle.alert_batch(store, 1, datetime.fromisoformat(L.AS_OF), consecutive=2, suppression_hours=L.QUIET_HOURS, factor=1.2)
    new = store.read("alerts", batches=[1])
    return new.select("vehicle_id", "first_detected_at", "anomaly_score", "top_features", "created_at")


@query
def s15_replay(t: Lake) -> DataFrame:
    _, gold = cycle.replay(t.bronze, t.vehicles, slide_seconds=L.WINDOW, lookback_seconds=L.LOOKBACK, unit_minutes=L.UNIT_MINUTES)
    return gold


def _erased(t: Lake) -> Store:
    store = _cleaned(t)
    store.erase(_requests(t), "officer", 9, L.AS_OF)
    return store


@query
def e5_store_erasure(t: Lake) -> DataFrame:
    """Every layer of the store after an erasure of all or nothing."""
    store = _erased(t)
    raw = store.read("bronze_telemetry").select(F.lit("bronze").alias("layer"), F.col("id").alias("bronze_id"), "vehicle_id",
                                                "latitude", "longitude", "raw_payload")
    clean = store.read("silver_telemetry").select(F.lit("silver").alias("layer"), "bronze_id", "vehicle_id", "latitude",
                                                  "longitude", F.lit("-").alias("raw_payload"))
    return raw.unionByName(clean).withColumn("bronze_id", _own_id())


@query
def e6_audit(t: Lake) -> DataFrame:
    return _erased(t).read("erasure_log").select(
        "vehicle_id", "bronze_count", "silver_count", "gold_count", "requested_by", "erased_at")


# health columns whose sums are exact in any order
_EXACT = ("vehicle_id", "window_start", "window_end", "avg_current_a", "avg_motor_temp_c", "avg_speed_kmh", "record_count")
LATE_DAYS = 10


def _paned(t: Lake) -> Store:
    """A store whose Gold stream met the readings out of order: each micro-batch spans the whole history."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    for n in range(FILES):
        store.write_batch("silver_telemetry", t.silver.where(F.col("bronze_id") % FILES == n), n)
    for n in range(FILES):  # one batch of the table after the other, as they come in
        folder = f"{store.path('silver_telemetry')}/event_date=*/batch_id={n}"
        rows = t.spark.read.schema(S.SILVER).parquet(folder)
        carried = CarriedPanes(t.spark, f"{store.root}/panes", L.WINDOW, L.LOOKBACK, L.UNIT_MINUTES, LATE_DAYS * L.DAY)
        closed, late = carried.update(rows, n)
        store.write_batch("gold_vehicle_health", closed, n)
        store.write_batch("silver_late", late, n)
    return store


@query
def stream_gold_panes(t: Lake) -> DataFrame:
    """Windows closed from readings on time."""
    return _paned(t).read("gold_vehicle_health").select(*_EXACT, "rolling_5min_discharge_rate")


@query
def stream_late_rows(t: Lake) -> DataFrame:
    """The side output of readings that came after their window had been closed."""
    return _paned(t).read("silver_late").select("bronze_id", "vehicle_id", "event_timestamp")


@query
def j2_latest_kept_up(t: Lake) -> DataFrame:
    """Newest rows per vehicle from a stored table that four batches bring up to date."""
    table = LatestTable(t.spark, staging_path(t.spark, "latest"), t.silver.schema)
    for n in range(FILES):
        table.update(t.silver.where(F.col("bronze_id") % FILES == n), n)
    return table.read().select("vehicle_id", "bronze_id", "event_timestamp", "battery_pct")


@query
def stream_online_status(t: Lake) -> DataFrame:
    """When vehicles go on and off line; spells still open at the end of the stream have not come out."""
    events = _in_batches(t, t.bronze.select("vehicle_id", "received_at", "id"), ["received_at", "id"], "arrivals")
    return jobs.transitions(_drained(t, jobs.status_stream(events, L.ONLINE, "10 minutes"), "status"))


@query
def stream_alerts_carried(t: Lake) -> DataFrame:
    """Alerts that a store's alert query appends, run lengths and last alerts carried over several micro-batches."""
    store = Store(t.spark, staging_path(t.spark, "store"))
    store.create()
    store.write_batch("gold_vehicle_health", t.stored_gold, 0)
    scored = _in_batches(t, t.predictions, ["predicted_at", "vehicle_id"], "scores")
    jobs.alert_query(store, staging_path(t.spark, "alerting"), None, scored, consecutive=2, suppression_hours=L.QUIET_HOURS,
                     factor=1.2).awaitTermination()
    return store.read("alerts").drop("id", "acknowledged_at", "acknowledged_by")


@query
def stream_alerts(t: Lake) -> DataFrame:
    path = staging_path(t.spark, "predictions")
    t.predictions.write.parquet(path)
    stream = t.spark.readStream.schema(t.predictions.schema).parquet(path)
    raised = _drained(t, stateful.alert_stream(stream, 2, L.QUIET_HOURS, 1.2), "alerts")
    return alerting.with_causes(raised, t.stored_gold)
