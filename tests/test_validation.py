import json
from datetime import timedelta

import pytest
from conftest import NOW
from pyspark.sql import functions as F

from odolake.functions.numeric import number_text
from odolake.functions.timing import parse_iso
from odolake.operators import ingest, validation

BASE = {
    "vehicle_id": "VF-214", "event_timestamp": "2031-03-09T14:45:00+00:00", "battery_pct": 58.25,
    "state_of_charge_kwh": 21.5, "voltage_v": 372.125, "current_a": 11.75, "motor_temp_c": 36.5,
    "latitude": 47.3125, "longitude": 8.55, "speed_kmh": 17.0, "regen_braking_event": True,
}


def changed(**kw):
    return json.dumps({**BASE, **kw})


def without(name):
    return json.dumps({k: v for k, v in BASE.items() if k != name})


CASES = [
    (changed(), None),
    (without("battery_pct"), "missing_field:battery_pct"),
    (without("speed_kmh"), "missing_field:speed_kmh"),
    (changed(motor_temp_c=None), "missing_field:motor_temp_c"),
    (changed(battery_pct=100.5), "out_of_range:battery_pct:100.5>max(100.0)"),
    (changed(battery_pct=-7), "out_of_range:battery_pct:-7.0<min(0.0)"),
    (changed(battery_pct=0), None),
    (changed(motor_temp_c=180), None),
    (changed(motor_temp_c=-41), "out_of_range:motor_temp_c:-41.0<min(-40.0)"),
    (changed(vehicle_id="bus 12"), "invalid_vehicle_id:bus 12:must_match_VF-NNN"),
    (changed(vehicle_id="VF-21"), "invalid_vehicle_id:VF-21:must_match_VF-NNN"),
    (changed(vehicle_id=" VF-214 "), None),
    (changed(vehicle_id="\tVF-214\n"), None),
    (changed(vehicle_id="VF-214\u00a0"), None),
    (changed(vehicle_id="VF-2\n14"), "invalid_vehicle_id:VF-2\n14:must_match_VF-NNN"),
    (changed(vehicle_id=""), "missing_field:vehicle_id"),
    (changed(vehicle_id=214), "missing_field:vehicle_id"),
    (without("vehicle_id"), "missing_field:vehicle_id"),
    ('["a", 3]', "invalid_format:payload_must_be_json_object"),
    ("null", "invalid_format:payload_must_be_json_object"),
    (changed(battery_pct=58), None),
    (changed(battery_pct="58"), None),
    (changed(battery_pct=" 5_8\t"), None),
    (changed(battery_pct="5__8"), "invalid_type:battery_pct:cannot_coerce_to_float"),
    (changed(battery_pct="58f"), "invalid_type:battery_pct:cannot_coerce_to_float"),
    (changed(battery_pct="nan"), "invalid_type:battery_pct:cannot_coerce_to_float"),
    (changed(battery_pct="-inf"), "out_of_range:battery_pct:-inf<min(0.0)"),
    (changed(battery_pct="Infinity"), "out_of_range:battery_pct:inf>max(100.0)"),
    (changed(battery_pct=-0.0001), "out_of_range:battery_pct:-0.0001<min(0.0)"),
    (changed(battery_pct=-0.000012), "out_of_range:battery_pct:-1.2e-05<min(0.0)"),
    (changed(battery_pct=12345678.5), "out_of_range:battery_pct:12345678.5>max(100.0)"),
    (changed(battery_pct=1e7), "out_of_range:battery_pct:10000000.0>max(100.0)"),
    (changed(battery_pct=4.5e20), "out_of_range:battery_pct:4.5e+20>max(100.0)"),
    (changed(battery_pct=True), None),
    (changed(battery_pct=[58]), "invalid_type:battery_pct:cannot_coerce_to_float"),
    (changed(current_a=-500), None),
    (changed(regen_braking_event=0), "invalid_type:regen_braking_event:expected_bool:got_int"),
    (changed(regen_braking_event=[]), "invalid_type:regen_braking_event:expected_bool:got_list"),
    (changed(event_timestamp=2.5), "invalid_type:event_timestamp:expected_str:got_float"),
    (changed(event_timestamp=(NOW + timedelta(seconds=75)).isoformat()),
     "invalid_timestamp:event_timestamp:more_than_60s_in_future"),
    (changed(event_timestamp=(NOW + timedelta(seconds=60)).isoformat()), None),
    (changed(event_timestamp="yesterday at noon"), "invalid_timestamp:event_timestamp:not_iso8601:yesterday at noon"),
    (changed(event_timestamp="2031-03-09T13:59:00+02:00"), None),
    (changed(event_timestamp="2031-03-09T13:59:00+02:00\t"), None),
    ('{"vehicle_id": ', "invalid_json"),
    ("", "empty_body"),
    (changed(note="z" * 4500), "payload_too_large"),
    (changed()[:-1] + ', "battery_pct": 640}', "out_of_range:battery_pct:640.0>max(100.0)"),
    # the first failure in field order wins
    (changed(battery_pct=640, vehicle_id="X", regen_braking_event=0), "out_of_range:battery_pct:640.0>max(100.0)"),
]


@pytest.fixture(scope="module")
def inspected(spark):
    rows = spark.createDataFrame([(i, NOW, raw) for i, (raw, _) in enumerate(CASES)],
                                 "id BIGINT, received_at TIMESTAMP, raw_payload STRING")
    return validation.inspect(rows).cache()


def test_first_failure_names_the_reason(inspected):
    got = {r.id: r.reason for r in inspected.collect()}
    assert got == {i: reason for i, (_, reason) in enumerate(CASES)}


def test_values_are_typed_and_trimmed(inspected):
    rows = {r.id: r for r in inspected.collect()}
    by_raw = {raw: rows[i] for i, (raw, _) in enumerate(CASES)}
    assert by_raw[changed(battery_pct=" 5_8\t")].battery_pct == 58.0
    assert by_raw[changed(battery_pct=True)].battery_pct == 1.0
    assert by_raw[changed(vehicle_id=" VF-214 ")].vehicle_id == "VF-214"
    assert by_raw[changed(vehicle_id=" VF-214 ")].limiter_key == " VF-214 "
    moved = by_raw[changed(event_timestamp="2031-03-09T13:59:00+02:00")].event_timestamp
    assert moved.isoformat() == "2031-03-09T11:59:00"


def test_every_event_is_routed_once(inspected):
    routed = inspected.withColumn("outcome", ingest.outcome())
    counts = {r.outcome: r.events for r in ingest.outcome_counts(routed).collect()}
    assert counts[ingest.TOO_LARGE] == 1
    assert counts[ingest.ACCEPTED] == sum(reason is None for _, reason in CASES)
    assert sum(counts.values()) == len(CASES)
    assert ingest.dead_letters(routed).count() == counts[ingest.INVALID]
    kept = {r.id: r.raw_payload for r in ingest.accepted_rows(routed).collect()}
    assert all(kept[i] == CASES[i][0] for i in kept)


def test_limited_events_are_dropped_before_field_checks(inspected):
    routed = inspected.withColumn("outcome", ingest.outcome(F.lit(False)))
    counts = {r.outcome: r.events for r in ingest.outcome_counts(routed).collect()}
    assert ingest.ACCEPTED not in counts
    assert counts[ingest.RATE_LIMITED] == inspected.where("limiter_key IS NOT NULL").count()


def test_numbers_print_like_their_literals(spark):
    values = [0.0, -0.5, 1e-4, 9.99e-5, -2.5e-7, 123456.789, 1e7, 1.5e15, 9.007e15, 1e16, -3.25e22, 1e100, 1.7e308, 5e-324]
    rows = spark.createDataFrame([(v,) for v in values], "x DOUBLE").select("x", number_text(F.col("x")).alias("t"))
    assert all(float(r.t) == r.x for r in rows.collect())
    assert [r.t for r in rows.collect()][:-1] == [repr(v) for v in values][:-1]


@pytest.mark.parametrize("text,expected", [
    ("2031-03-09T12:00:00Z", "2031-03-09T12:00:00"), ("2031-03-09T12:00:00.25+00:00", "2031-03-09T12:00:00.250000"),
    ("2031-03-09 12:00", "2031-03-09T12:00:00"), ("2031-03-09", "2031-03-09T00:00:00"),
    ("20310309T120000", "2031-03-09T12:00:00"), ("2031-03-09T12:00:00-0130", "2031-03-09T13:30:00"),
    ("2031-03-09T12:00:00+02", "2031-03-09T10:00:00"), ("2031-W10-7", None), ("2031-13-09", None),
    ("2031-03-09T25:00:00", None), ("12:00", None), ("", None), ("2031-03-09T12", "2031-03-09T12:00:00"),
])
def test_iso_text(spark, text, expected):
    got = spark.createDataFrame([(text,)], "s STRING").select(parse_iso(F.col("s")).alias("t")).first().t
    assert (got.isoformat() if got else None) == expected
