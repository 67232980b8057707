from conftest import ago, bronze_rows, vehicle_rows
from pyspark.sql import functions as F

from odolake.operators import cleaning as C


def summary(spark, rows, known=("VF-001", "VF-002")):
    assessed = C.assess(bronze_rows(spark, rows), vehicle_rows(spark, *known))
    return assessed, C.batch_summary(assessed, by=None).first()


def test_good_rows_are_written_and_enriched(spark):
    assessed, s = summary(spark, [(1, "VF-001", ago(seconds=9), 61.0), (2, "VF-002", ago(seconds=5), 44.5)])
    assert (s.records_read, s.records_written, s.records_failed, s.circuit_open) == (2, 2, 0, False)
    rows = C.cleaned_rows(assessed).orderBy("bronze_id").collect()
    assert [(r.bronze_id, r.rated_capacity_kwh, r.regen_braking_event) for r in rows] == [(1, 58.0, 0), (2, 58.0, 0)]
    assert C.progress(C.cleaned_rows(assessed)).first().watermark == 2


def test_one_bad_row_alone_opens_the_breaker(spark):
    assessed, s = summary(spark, [(1, "VF-001", ago(seconds=9), 640.0)])
    assert (s.records_read, s.records_written, s.records_failed, s.circuit_open) == (1, 0, 1, True)
    assert C.rejected_rows(assessed).first().skip_reason == "out_of_range:battery_pct"


def test_skip_reasons_in_order(spark):
    assessed, _ = summary(spark, [
        (1, "VF-999", ago(seconds=9), 640.0), (2, "VF-001", ago(seconds=9), 640.0, {"speed_kmh": None}),
        (3, "VF-001", ago(seconds=9), float("nan")), (4, "VF-001", ago(seconds=9), 100.0, {"regen_braking_event": None})])
    got = {r.id: r.skip_reason for r in assessed.collect()}
    assert got == {1: "unknown_vehicle", 2: "null_field:speed_kmh", 3: "out_of_range:battery_pct", 4: None}
    assert C.cleaned_rows(assessed).first().regen_braking_event == 0


def test_breaker_threshold_is_strict(spark):
    def bad(n, total):
        return [(i, "VF-001", ago(seconds=9), 640.0 if i < n else 50.0) for i in range(total)]

    assert summary(spark, bad(9, 10))[1].circuit_open
    assert not summary(spark, bad(1, 10))[1].circuit_open
    assert summary(spark, bad(2, 10))[1].circuit_open


def test_replay_halts_or_sets_aside_open_batches(spark):
    rows = [(i, "VF-001", ago(seconds=9), 640.0 if 11 <= i <= 15 else 50.0) for i in range(1, 31)]
    numbered = C.with_batch_number(bronze_rows(spark, rows), rows=10)
    assessed = C.assess(numbered, vehicle_rows(spark, "VF-001"))
    assert {r.id for r in C.committed_rows(assessed).collect()} == set(range(1, 11))
    kept = {r.id for r in C.committed_rows(assessed, on_trip="quarantine").collect()}
    assert kept == set(range(1, 11)) | set(range(21, 31))


def test_batches_orphans_and_missing_keys(spark):
    bronze = bronze_rows(spark, [(i, "VF-001", ago(seconds=9), 50.0) for i in range(1, 8)])
    assert [r.id for r in C.next_batch(bronze, 2, 3).collect()] == [3, 4, 5]
    silver = C.silver(bronze, vehicle_rows(spark, "VF-001"))
    assert [r.bronze_id for r in C.lineage_orphans(silver, bronze.where("id <> 4")).collect()] == [4]
    new = vehicle_rows(spark, "VF-001", "VF-003", "VF-003")
    assert [r.vehicle_id for r in C.missing_keys(new, vehicle_rows(spark, "VF-001")).collect()] == ["VF-003"]
    assert C.progress(silver.where(F.lit(False))).first().watermark == 0
