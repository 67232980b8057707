import random
from datetime import datetime, timedelta

import pytest
from conftest import NOW, ago, silver_rows

from odolake import schemas as S
from odolake.operators import health as H


def snapshot(spark, rows, **kw):
    silver = silver_rows(spark, [(i, *r) for i, r in enumerate(rows, 1)])
    got = H.gold_snapshot(silver, NOW, window_seconds=300, **kw).collect()
    return {r.vehicle_id: r for r in got}


@pytest.mark.parametrize("rows,rate,score", [  # 333 V are worth 8.25 points
    ([("VF-001", ago(seconds=0), 90.0, {"motor_temp_c": 38.0})], 0.0, 84.2),  # 36 + 30 + 8.25 + 10, ties to even
    ([("VF-001", ago(minutes=m), b, {"motor_temp_c": 40.0}) for m, b in ((2, 78.0), (1, 79.0), (0, 80.0))], -1.0, 86.5),
    ([("VF-001", ago(minutes=m), b, {"motor_temp_c": 70.0}) for m, b in ((2, 58.0), (1, 59.0), (0, 60.0))], -1.0, 67.3),
    ([("VF-001", ago(seconds=1), 100.0, {"motor_temp_c": 20.0})], 0.0, 88.2),
    ([("VF-001", ago(minutes=m), b, {"motor_temp_c": 120.0}) for m, b in ((5, 50.0), (0, 40.0))], 2.0, 26.2),  # 18 + 0 + 8.25 + 0
])
def test_hand_computed_rows(spark, rows, rate, score):
    row = snapshot(spark, [(v, at, battery, {**more, "voltage_v": 333.0}) for v, at, battery, more in rows])["VF-001"]
    assert (row.rolling_5min_discharge_rate, row.health_score, row.record_count) == (rate, score, len(rows))


def test_same_time_gives_no_rate(spark):
    assert snapshot(spark, [("VF-001", ago(seconds=5), 50.0), ("VF-001", ago(seconds=5), 40.0)])["VF-001"] \
        .rolling_5min_discharge_rate == 0.0


def test_one_row_per_vehicle_and_erased_left_out(spark):
    rows = [("VF-001", ago(seconds=5), 50.0), ("VF-002", ago(seconds=5), 50.0), (S.ERASED, ago(seconds=5), 50.0)]
    assert set(snapshot(spark, rows)) == {"VF-001", "VF-002"}
    assert S.ERASED in snapshot(spark, rows, include_erased=True)


def test_window_and_lookback_differ(spark):
    silver = silver_rows(spark, [(1, "VF-001", ago(seconds=200), 60.0), (2, "VF-001", ago(seconds=30), 50.0),
                                 (3, "VF-002", ago(seconds=31), 50.0)])
    rows = H.gold_snapshot(silver, NOW).collect()
    assert [(r.vehicle_id, r.avg_battery_pct, r.record_count) for r in rows] == [("VF-001", 50.0, 1)]
    assert rows[0].rolling_5min_discharge_rate == round(10.0 / (170 / 60), 4)


def history(spark, seed=3, vehicles=4, n=400, span=3600):
    rng = random.Random(seed)
    base = datetime(2026, 6, 7, 10, 0, 0, tzinfo=NOW.tzinfo)
    rows = [(i, f"VF-00{rng.choice([1, 1, 1, *range(1, vehicles + 1)])}",
             base + timedelta(seconds=rng.randrange(span)), rng.uniform(10, 100)) for i in range(1, n + 1)]
    return rows


def expected_rates(rows, lookback=300):
    out = {}
    for i, v, t, b in rows:
        old = min((x for x in rows if x[1] == v and t - timedelta(seconds=lookback) <= x[2] and (x[2], x[0]) <= (t, i)),
                  key=lambda x: (x[2], x[0]))
        minutes = (t - old[2]).total_seconds() / 60
        out[i] = (old[3] - b) / minutes if minutes > 0 else 0.0
    return out


@pytest.mark.parametrize("bucket", [300, 420, 5000])
def test_rolling_rate_equals_brute_force_for_any_bucket(spark, bucket):
    rows = history(spark)
    got = {r.bronze_id: r.discharge_rate for r in H.rolling_rate(silver_rows(spark, rows), bucket_seconds=bucket).collect()}
    want = expected_rates(rows)
    assert got.keys() == want.keys()
    assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_sliding_windows_equal_snapshots(spark):
    rows = history(spark, n=300)
    silver = silver_rows(spark, rows).cache()
    sliding = H.gold_sliding(silver).cache()
    at = datetime(2026, 6, 7, 10, 20, 0, tzinfo=NOW.tzinfo)
    want = H.gold_snapshot(silver.where(f"event_timestamp < '{at:%Y-%m-%d %H:%M:%S}'"), at).drop("aggregated_at")
    got = sliding.where(f"window_end = '{at:%Y-%m-%d %H:%M:%S}'").drop("aggregated_at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sliding.count() == len({(v, int(t.timestamp()) // 30) for _, v, t, _ in rows})


def test_plans_stay_small(spark):
    silver = silver_rows(spark, history(spark, n=50))
    plan = H.gold_snapshot(silver, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
