import json
import random
from datetime import timedelta, timezone

import pytest
from conftest import NOW, ago, bronze_rows, ended, silver_rows, vehicle_rows
from pyspark.sql import functions as F
from test_validation import changed

from odolake import schemas as S
from odolake.operators import erasure, forest, health, rate_limit
from odolake.operators.alerting import replay_alerts
from odolake.plans import cycle, reports
from odolake.sources.store import Store, with_batch_ids
from odolake.streaming import jobs, stateful


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "lake"))
    s.create()
    s.create()
    s.seed_vehicles(vehicle_rows(spark, "VF-001", "VF-002"), 0)
    return s


def test_batch_ids_are_dense_within_a_batch(spark):
    ids = [r.id for r in with_batch_ids(spark.range(100, numPartitions=7).select(F.col("id").alias("x")), 3).collect()]
    assert sorted(ids) == [(3 << 40) + i for i in range(1, 101)]


def test_seeding_adds_only_new_keys(spark, store):
    store.seed_vehicles(vehicle_rows(spark, "VF-002", "VF-003"), 1)
    assert sorted(r.vehicle_id for r in store.read("vehicle_metadata").collect()) == ["VF-001", "VF-002", "VF-003"]


def test_a_retried_batch_is_written_once(spark, store):
    rows = bronze_rows(spark, [(1, "VF-001", ago(seconds=9), 75.0)])
    for _ in range(2):
        store.write_batch("bronze_telemetry", rows, 5)
    assert store.read("bronze_telemetry").count() == 1
    assert store.read("bronze_telemetry", since=NOW).count() == 0


def test_clean_batch_is_idempotent_and_halts(spark, store):
    store.write_batch("bronze_telemetry", bronze_rows(
        spark, [(i, "VF-001", ago(seconds=9), 75.0) for i in range(1, 20)] + [(20, "VF-001", ago(seconds=9), 999.0)]), 1)
    first = cycle.clean_batch(store, 1, NOW)
    assert (first["records_read"], first["records_written"], first["records_failed"], first["watermark"]) == (20, 19, 1, 20)
    assert cycle.clean_batch(store, 2, NOW)["records_read"] == 0
    assert store.read("silver_telemetry").count() == 19 and store.read("silver_rejects").count() == 1
    store.write_batch("bronze_telemetry", bronze_rows(
        spark, [(i, "VF-001", ago(seconds=9), 999.0) for i in range(21, 30)] + [(30, "VF-001", ago(seconds=9), 50.0)]), 2)
    tripped = cycle.clean_batch(store, 3, NOW)
    assert tripped["circuit_open"] and tripped["watermark"] == 20
    assert store.read("silver_telemetry").count() == 19


def test_injected_fault_alerts_within_three_cycles_and_erasure(spark, store):
    """Twelve vehicles, one losing charge three times as fast: cycle, alert, report, erase."""
    fleet = [f"VF-{i:03d}" for i in range(1, 13)]
    store.seed_vehicles(vehicle_rows(spark, *fleet), 1)
    rows, ident, raised, clocks = [], 0, [], [NOW + timedelta(seconds=30 * c) for c in range(3)]
    for tick in range(0, 390, 15):
        for v in fleet:
            rate, temp = (1.2, 75.0) if v == "VF-001" else (0.4, 42.0)
            ident += 1
            rows.append((ident, v, NOW - timedelta(seconds=300 - tick), 80.0 - rate * tick / 60, {"motor_temp_c": temp}))
    bronze = bronze_rows(spark, rows).cache()
    for n, now in enumerate(clocks):
        arrived = bronze.where((F.col("event_timestamp") <= F.lit(now)) & (F.col("event_timestamp") > F.lit(
            now - timedelta(seconds=30 if n else 400))))
        store.write_batch("bronze_telemetry", arrived, n)
        summary = cycle.run_cycle(store, n, now, model={"trees": 30})
        assert not summary["circuit_open"]
        raised.append(summary.get("alerts_raised", 0))
    assert sum(raised) >= 1
    worst = reports.latest_scores(store.read("predictions")).first()
    assert worst.vehicle_id == "VF-001" and worst.is_anomaly
    assert store.read("predictions").where("mode = 'shadow'").count() == 36

    before = {n: store.read(n).count() for n in S.TABLES}
    healthy = store.read("gold_vehicle_health").where("vehicle_id = 'VF-001'").count()  # three snapshots and the backlog
    assert healthy > 3
    keys = spark.createDataFrame([("VF-001",), ("VF-777",)], "vehicle_id STRING")
    log = store.erase(keys, "officer", 9, NOW).first()
    assert (log.vehicle_id, log.bronze_count, log.silver_count, log.gold_count, log.prediction_count) == (
        "VF-001", 26 - 1, 26 - 1, healthy, 6)
    assert log.alert_count == store.read("alerts").where(F.col("vehicle_id") == S.ERASED).count() >= 1
    for name in S.TABLES:
        if name == "erasure_log":
            continue
        t = store.read(name)
        assert t.count() == before[name] - (name == "vehicle_metadata")
        assert t.where("vehicle_id = 'VF-001'").count() == 0 if "vehicle_id" in t.columns else True
    gone = store.read("bronze_telemetry").where(F.col("vehicle_id") == S.ERASED)
    assert gone.where("latitude IS NOT NULL OR longitude IS NOT NULL").count() == 0
    assert {r.raw_payload for r in gone.collect()} == {S.ERASED}
    assert store.read("erasure_log").count() == 1
    assert store.erase(keys, "officer", 10, NOW).count() == 0


def test_dead_letters_name_a_vehicle_through_any_blanks(spark):
    ids = ["\\tVF-001\\n", "VF-001\u00a0", " VF-001 ", "\u2003VF-001", "VF-0011"]
    rows = [(k, f'{{"vehicle_id": "{v}", "latitude": 91}}', "out of range") for k, v in enumerate(ids)]
    dlq = spark.createDataFrame(rows, "id INT, raw_payload STRING, error_reason STRING")
    keys = spark.createDataFrame([("VF-001",)], "vehicle_id STRING")
    assert {r.id for r in erasure.naming(dlq, keys).collect()} == {0, 1, 2, 3}
    out = {r.id: r.raw_payload for r in erasure.scrub_dead_letters(dlq, keys).collect()}
    assert {k for k, p in out.items() if p == S.ERASED} == {0, 1, 2, 3} and out[4] == rows[4][1]


def test_erasure_scrubs_dead_letters_and_purge_drops_old_dates(spark, store):
    dlq = spark.createDataFrame(
        [(1, ago(days=40), changed(battery_pct=640, vehicle_id="VF-001"), "r", None), (2, NOW, json.dumps({"vehicle_id": "VF-002"}), "r", None),
         (3, NOW, "not json", "r", None)], S.DLQ)
    store.write_batch("bronze_dlq", dlq, 1)
    store.erase(spark.createDataFrame([("VF-001",)], "vehicle_id STRING"), "x", 2, NOW)
    payloads = {r.id: r.raw_payload for r in store.read("bronze_dlq").collect()}
    assert payloads[1] == S.ERASED and payloads[3] == "not json" and "VF-002" in payloads[2]
    store.purge("bronze_dlq", NOW, "30 DAYS")
    assert {r.id for r in store.read("bronze_dlq").collect()} == {2, 3}


def test_a_backlog_reaches_gold(spark, store):
    """Far more rows than one window holds, cleaned in one cycle: each is averaged somewhere."""
    rows = [(i, "VF-001", NOW - timedelta(seconds=5 * i + 1), 60.0) for i in range(1, 1300)]
    store.write_batch("bronze_telemetry", bronze_rows(spark, rows), 1)
    summary = cycle.run_cycle(store, 1, NOW)
    assert summary["records_written"] == 1299 and not summary["errors"]
    gold = store.read("gold_vehicle_health")
    missed = gold.where(F.col("window_end") <= F.lit(NOW))
    assert missed.agg(F.sum("record_count")).first()[0] >= 1299
    assert gold.dropDuplicates(["vehicle_id", "window_start"]).count() == gold.count()


def test_late_readings_supersede_their_window_and_none_counts_twice(spark, store):
    """Cycles off the grid, the first with two thirds of the readings: the rest comes late, into windows and beside them."""
    rng = random.Random(5)
    first, second = NOW - timedelta(seconds=77), NOW
    rows = [(i, f"VF-{i % 2 + 1:03d}", first - timedelta(seconds=rng.randrange(1, 400), milliseconds=500), 20.0 + i % 50)
            for i in range(1, 240)]
    rows += [(i, "VF-001", second - timedelta(seconds=rng.randrange(1, 77), milliseconds=250), 55.0) for i in range(240, 270)]
    early = [r for r in rows if r[0] % 3 and r[2] < first]
    late = [r for r in rows if r not in early]
    shape = {"window_seconds": 30, "lookback_seconds": 120}
    for n, (part, as_of) in enumerate(((early, first), (late, second), ([], second + timedelta(seconds=30))), 1):
        store.write_batch("silver_telemetry", silver_rows(spark, part) if part else store.read("silver_telemetry").limit(0), n)
        cycle.aggregate_batch(store, n, as_of, **shape)
    current = store.current("gold_vehicle_health")
    assert store.read("gold_vehicle_health").count() > current.count()
    found = current.orderBy("vehicle_id", "window_start").collect()
    assert sum(r.record_count for r in found) == len(rows)
    for a, b in zip(found, found[1:]):
        assert a.vehicle_id != b.vehicle_id or a.window_end <= b.window_start
    for r in found:
        ours = [x for x in rows if x[1] == r.vehicle_id]
        utc = lambda t: t.astimezone().replace(tzinfo=timezone.utc) if t.tzinfo is None else t
        start, end = utc(r.window_start), utc(r.window_end)
        inside = [x[3] for x in ours if start <= x[2] < end]
        assert r.record_count == len(inside) and abs(r.avg_battery_pct - sum(inside) / len(inside)) < 0.006
        seen = sorted((x[2], x[0], x[3]) for x in ours if end - timedelta(seconds=120) <= x[2] < end)
        minutes = (seen[-1][0] - seen[0][0]).total_seconds() / 60
        rate = (seen[0][2] - seen[-1][2]) / minutes if minutes else 0.0
        assert abs(r.rolling_5min_discharge_rate - rate) < 1e-3


def test_a_failing_stage_is_named_and_does_not_stop_the_others(spark, store, monkeypatch):
    gold = spark.range(40).select(
        F.format_string("VF-%03d", F.col("id") % 2 + 1).alias("vehicle_id"),
        (F.lit(NOW) - F.make_dt_interval(secs=30 * F.col("id") + 30)).alias("window_start"), F.lit(NOW).alias("window_end"),
        (F.lit(NOW) - F.make_dt_interval(secs=30 * F.col("id"))).alias("aggregated_at"),
        *[(F.rand(k) * 10).alias(f) for k, f in enumerate(S.FEATURES)])
    store.write_batch("gold_vehicle_health", gold, 1)

    def broken(*args, **kw):
        raise RuntimeError("no space")

    monkeypatch.setattr(cycle, "aggregate_batch", broken)
    first = cycle.run_cycle(store, 2, NOW, model={"trees": 5})
    assert set(first["errors"]) == {"aggregate"} and first["predictions_written"] == 4
    trained = spark.read.parquet(f"{store.root}/_models/production/models").count()
    cycle.run_cycle(store, 3, NOW + timedelta(seconds=30), model={"trees": 5})
    assert spark.read.parquet(f"{store.root}/_models/production/models").count() == trained == 1


def silver_stream(store, checkpoint):
    q = jobs.silver_query(store, str(checkpoint), None)
    ended(q)
    rows = store.read("silver_telemetry").select("bronze_id").collect()
    assert len(rows) == len(set(rows)) and store.read("silver_rejects").count() == 0
    return len(rows)


def test_streams_read_no_row_twice_after_erasure_and_retry(spark, store, tmp_path):
    def batch(n):
        return bronze_rows(spark, [(20 * n + i, f"VF-00{1 + i % 2}", ago(seconds=i), 70.0) for i in range(20)])

    store.write_batch("bronze_telemetry", batch(0), 1)
    assert silver_stream(store, tmp_path / "c") == 20
    store.erase(spark.createDataFrame([("VF-001",)], "vehicle_id STRING"), "x", 2, NOW)
    assert silver_stream(store, tmp_path / "c") == 20
    store.write_batch("bronze_telemetry", batch(0), 1)  # the same batch again
    assert silver_stream(store, tmp_path / "c") == 20
    assert store.read("bronze_telemetry").count() == 20
    assert store.read("silver_telemetry").where(F.col("vehicle_id") == S.ERASED).count() == 10


def test_an_interrupted_erasure_is_finished_with_its_first_counts(spark, store, monkeypatch):
    rows = bronze_rows(spark, [(i, f"VF-00{1 + i % 2}", ago(seconds=i), 70.0) for i in range(1, 11)])
    store.write_batch("bronze_telemetry", rows, 1)
    cycle.clean_batch(store, 1, NOW)
    keys = spark.createDataFrame([("VF-001",)], "vehicle_id STRING")
    write = Store.write_batch

    def stop(self, name, *args):
        if name == "erasure_log":
            raise RuntimeError("stopped")
        return write(self, name, *args)

    monkeypatch.setattr(Store, "write_batch", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        store.erase(keys, "x", 7, NOW)
    assert store.read("erasure_log").count() == 0
    monkeypatch.setattr(Store, "write_batch", write)
    store.recover()
    log = store.read("erasure_log").first()
    assert (log.vehicle_id, log.bronze_count, log.silver_count) == ("VF-001", 5, 5)
    assert store.read("silver_telemetry").where("vehicle_id = 'VF-001'").count() == 0
    assert store.erase(keys, "x", 8, NOW).count() == 0 and store.read("erasure_log").count() == 1


# --- streams ------------------------------------------------------------------

def test_stream_from_text_to_gold(spark, store, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    good = [changed(vehicle_id="VF-001", event_timestamp=(NOW + timedelta(seconds=s)).isoformat(), battery_pct=90 - s / 60)
            for s in range(0, 600, 20)]
    (inbox / "a.txt").write_text("\n".join([*good, changed(battery_pct=640), "{"]))
    arrival = F.lit(NOW + timedelta(seconds=600))

    def run():
        for start in (lambda: jobs.ingest_query(
                          jobs.raw_text(spark, str(inbox), arrival), store, str(tmp_path / "c1"), None, capacity=None),
                      lambda: jobs.silver_query(store, str(tmp_path / "c2"), None),
                      lambda: jobs.gold_query(store, str(tmp_path / "c3"), None, lateness_seconds=10)):
            q = start()
            ended(q)

    run()
    assert store.read("bronze_telemetry").count() == 30 and store.read("bronze_dlq").count() == 2
    run()  # nothing new: nothing is read twice
    assert store.read("bronze_telemetry").count() == 30 and store.read("silver_telemetry").count() == 30
    gold = store.read("gold_vehicle_health").drop("aggregated_at")
    batch = health.gold_sliding(store.read("silver_telemetry")).drop("aggregated_at")
    late = batch.where(F.col("window_end") <= F.lit(NOW + timedelta(seconds=560)))
    streamed = set(map(tuple, gold.collect()))
    assert streamed and streamed <= set(map(tuple, batch.collect()))
    assert {r[:2] for r in map(tuple, late.collect())} - {r[:2] for r in streamed} <= {
        r[:2] for r in map(tuple, batch.orderBy(F.desc("window_start")).limit(11).collect())}


def test_the_limiter_stands_before_the_field_checks_of_a_stream(spark, store, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    lines = [changed(vehicle_id="VF-001", speed_kmh=k) for k in range(6)] + [changed(vehicle_id="VF-002", battery_pct=640), "{"]
    (inbox / "a.txt").write_text("\n".join(lines))
    events = jobs.raw_text(spark, str(inbox), F.lit(NOW)).withColumn("client_ip", F.lit("10.0.0.9"))
    q = jobs.ingest_query(events, store, str(tmp_path / "c"), None)
    ended(q)
    assert store.read("bronze_telemetry").count() == 3  # of six, the capacity
    refused = store.read("bronze_dlq").collect()
    assert sorted(r.error_reason.split(":")[0] for r in refused) == ["invalid_json", "out_of_range"]
    assert {r.client_ip for r in refused} == {"10.0.0.9"}


def test_the_limiter_keeps_its_buckets_between_micro_batches(spark, store, tmp_path):
    """Eight events of one vehicle within a second, in two files read one after the other: the capacity passes once."""
    inbox = tmp_path / "inbox"
    for n in (0, 1):
        rows = [(changed(vehicle_id="VF-001", speed_kmh=4 * n + k), NOW + timedelta(seconds=(4 * n + k) / 10), "10.0.0.9")
                for k in range(4)]
        spark.createDataFrame(rows, "raw_payload STRING, received_at TIMESTAMP, client_ip STRING").coalesce(1).write.mode(
            "append").parquet(str(inbox))
        events = spark.readStream.schema("raw_payload STRING, received_at TIMESTAMP, client_ip STRING").option(
            "maxFilesPerTrigger", 1).parquet(str(inbox))
        if n == 0:  # once for the first file, then restarted with both
            ended(jobs.ingest_query(events, store, str(tmp_path / "c"), None))
            assert sorted(r.speed_kmh for r in store.read("bronze_telemetry").collect()) == [0, 1, 2]
    ended(jobs.ingest_query(events, store, str(tmp_path / "c"), None))
    assert sorted(r.speed_kmh for r in store.read("bronze_telemetry").collect()) == [0, 1, 2]
    assert store.read("bronze_dlq").count() == 0


def test_one_row_group_of_a_stream_is_inspected_by_many_tasks(spark, store, tmp_path, monkeypatch):
    """A micro-batch that is read by one task is checked by all, and its events are numbered as they came."""
    rows = [(changed(vehicle_id="VF-001", speed_kmh=k), NOW + timedelta(seconds=k)) for k in range(100)]
    spark.createDataFrame(rows, "raw_payload STRING, received_at TIMESTAMP").coalesce(1).write.parquet(str(tmp_path / "inbox"))
    events = spark.readStream.schema("raw_payload STRING, received_at TIMESTAMP").parquet(str(tmp_path / "inbox"))
    inspect, sizes = jobs.validation.inspect, []

    def watched(batch, **rules):
        sizes.extend(r["count"] for r in batch.groupBy(F.spark_partition_id().alias("part")).count().collect())
        return inspect(batch, **rules)

    monkeypatch.setattr(jobs.validation, "inspect", watched)
    ended(jobs.ingest_query(events, store, str(tmp_path / "c"), None, capacity=None))
    assert sum(sizes) == 100 and max(sizes) <= 2 * 100 / spark.sparkContext.defaultParallelism
    assert [r.speed_kmh for r in store.read("bronze_telemetry").orderBy("id").collect()] == list(range(100))


def test_open_breaker_stops_the_stream_or_sets_the_batch_aside(spark, store, tmp_path):
    store.write_batch("bronze_telemetry", bronze_rows(
        spark, [(i, "VF-001", ago(seconds=9), 999.0 if i < 9 else 50.0) for i in range(10)]), 1)
    q = jobs.silver_query(store, str(tmp_path / "c"), None)
    with pytest.raises(Exception, match="8|9"):
        q.awaitTermination(60)
    assert store.read("silver_telemetry").count() == 0
    ended(jobs.silver_query(store, str(tmp_path / "d"), None, on_trip="quarantine"))
    assert store.read("silver_telemetry").count() == 0
    assert store.read("silver_rejects").where("skip_reason = 'batch_quarantined'").count() == 1
    assert store.read("silver_rejects").count() == 10


def _drain(stream, path, checkpoint):
    q = (stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    ended(q)


def test_streamed_limiter_and_alerts_equal_batch(spark, store, tmp_path):
    rows = [(i, f"VF-00{1 + i % 2}", NOW + timedelta(seconds=(i * 7) % 90 + 100 * (i // 40)), 50.0) for i in range(80)]
    bronze = bronze_rows(spark, rows).cache()
    for part in (0, 1):
        store.write_batch("bronze_telemetry", bronze.where(f"id >= {part * 40} AND id < {part * 40 + 40}").coalesce(1), part)
        scores = bronze.where(f"id >= {part * 40} AND id < {part * 40 + 40}").select(
            "vehicle_id", F.col("event_timestamp").alias("window_start"), (-F.col("id") / 100.0).alias("anomaly_score"),
            (F.col("id") % 7 != 0).alias("is_anomaly"), F.lit("v1").alias("model_version"),
            F.lit("production").alias("mode"), F.col("event_timestamp").alias("predicted_at"))
        store.write_batch("predictions", scores.coalesce(1), part)
    one = {"maxFilesPerTrigger": "1"}
    _drain(stateful.limit_stream(store.stream("bronze_telemetry", **one)), str(tmp_path / "o1"), str(tmp_path / "k1"))
    want = {tuple(r) for r in rate_limit.token_bucket(bronze).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "o1")).select("id", "allowed").collect()} == want
    _drain(stateful.alert_stream(store.stream("predictions", **one)), str(tmp_path / "o2"), str(tmp_path / "k2"))
    columns = ["vehicle_id", "first_detected_at", "run_started_at", "anomaly_score", "created_at"]
    want = {tuple(r) for r in replay_alerts(store.read("predictions")).select(columns).collect()}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "o2")).select(columns).collect()} == want


def test_streams_score_and_alert(spark, store, tmp_path):
    """Stored model, new health rows, predictions of both modes, and an alert for the odd vehicle only."""
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1000)) / F.lit(1000.0) for i in range(5)]
    odd = F.when(F.col("id") % 50 == 0, 1.0).otherwise(0.0)
    start = F.lit(NOW) + F.make_dt_interval(secs=30 * F.floor(F.col("id") / 50))
    gold = spark.range(200).select(
        F.format_string("VF-%03d", F.col("id") % 50).alias("vehicle_id"), start.alias("window_start"),
        (start + F.expr("INTERVAL 30 SECONDS")).alias("window_end"), (start + F.expr("INTERVAL 30 SECONDS")).alias("aggregated_at"),
        (70 + h[0]).alias("avg_battery_pct"), (350 + h[1]).alias("avg_voltage_v"), (90 + h[2]).alias("avg_current_a"),
        (45 + h[3] + 40 * odd).alias("avg_motor_temp_c"), (0.4 + h[4] / 10 + odd).alias("rolling_5min_discharge_rate"),
        F.lit(60.0).alias("avg_speed_kmh"), F.lit(50.0).alias("health_score"), F.lit(1).cast("bigint").alias("record_count"))
    store.write_batch("gold_vehicle_health", gold, 1)
    path = str(tmp_path / "models")
    for seed, at in ((1, ago(days=2)), (42, NOW)):
        forest.save_forest(spark, forest.fit_forest(gold, NOW, trees=20, seed=seed, contamination=0.02), path, at)
    live, shadow = forest.load_forest(spark, path, NOW), forest.load_forest(spark, path, ago(days=1))
    assert forest.load_forest(spark, path, ago(days=3)) is None and live.offset != shadow.offset
    for start_query in (lambda: jobs.predict_query(store, str(tmp_path / "p"), live, shadow, None),
                        lambda: jobs.alert_query(store, str(tmp_path / "a"), None)):
        q = start_query()
        ended(q)
    assert {(r.mode, r["count"]) for r in store.read("predictions").groupBy("mode").count().collect()} == {
        ("production", 200), ("shadow", 200)}
    alerts = store.read("alerts").collect()
    assert {r.vehicle_id for r in alerts} == {"VF-000"}
    assert alerts[0].top_features[0] == "rolling_5min_discharge_rate"


def test_reports_on_stored_tables(spark, store):
    store.write_batch("silver_telemetry", silver_rows(spark, [(1, "VF-001", ago(seconds=9), 75.0)]), 1)
    t = {n: store.read(n) for n in S.TABLES}
    summary = reports.fleet_summary(t, NOW).first()
    assert (summary.total_vehicles, summary.online_vehicles, summary.avg_battery_pct, summary.latest_event_at) == (2, 0, 0.0, None)
    stages = {r.stage: (r.status, r.lag_seconds) for r in reports.stage_health(t, NOW).collect()}
    assert stages["ingestion"] == ("no_data", None) and stages["silver"] == ("ok", 9)
    assert reports.fleet_positions(t).first().vehicle_id == "VF-001"
    detail = reports.vehicle_detail(t, "VF-001", NOW)
    assert detail["metadata"].count() == 1 and detail["telemetry"].count() == 1
    assert [r.vehicle_id for r in reports.fleet_vehicles(t).collect()] == ["VF-001", "VF-002"]


