from datetime import datetime, timedelta, timezone

import pytest
from conftest import ended

from odolake import schemas as S
from odolake.operators import alerting as A

T0 = datetime(2026, 6, 7, 8, 0, 0, tzinfo=timezone.utc)


def predictions(spark, rows, mode="production", vehicle="VF-001"):
    """rows: (seconds, anomalous, score)"""
    return spark.createDataFrame(
        [(vehicle, T0 + timedelta(seconds=s), float(score), bool(flag), "v1.0", mode, T0 + timedelta(seconds=s))
         for s, flag, score in rows], S.PREDICTIONS)


def at(df):
    utc = [r.created_at.replace(tzinfo=timezone.utc) for r in df.collect()]
    return sorted(round((t - T0).total_seconds()) for t in utc)


LATE = 4 * 3600 + 60
SEQUENCES = [
    ([(0, 1, -0.10)], []),
    ([(0, 1, -0.10), (30, 1, -0.10)], [30]),
    ([(0, 1, -0.10), (30, 1, -0.10), (60, 1, -0.12)], [30]),
    ([(0, 1, -0.10), (30, 1, -0.10), (60, 1, -0.12), (90, 1, -0.13)], [30, 90]),
    ([(0, 1, -0.10), (30, 1, -0.10), (60, 1, -0.13), (90, 1, -0.15)], [30, 60]),
    ([(0, 1, -0.1), (30, 0, 0.1), (60, 1, -0.1)], []),
    ([(s, 1, -0.10) for s in (*range(0, LATE, 30), LATE)], [30, 30 + 4 * 3600 + 30]),
    ([(0, 1, -0.1), (30, 1, -0.1), (LATE, 1, -0.1)], [30, LATE]),
]


@pytest.mark.parametrize("rows,expected", SEQUENCES)
def test_replay(spark, rows, expected):
    assert at(A.replay_alerts(predictions(spark, rows))) == expected


def test_rescored_window_counts_once_and_shadow_never_alerts(spark):
    p = predictions(spark, [(0, 1, -0.1)])
    again = p.selectExpr("vehicle_id", "window_start", "anomaly_score", "is_anomaly", "model_version", "mode",
                         "predicted_at + INTERVAL 30 SECONDS AS predicted_at")
    assert at(A.replay_alerts(p.unionByName(again))) == []
    assert at(A.replay_alerts(predictions(spark, [(0, 1, -0.1), (30, 1, -0.1)], mode="shadow"))) == []


def test_run_start_is_the_first_anomalous_window(spark):
    rows = [(0, 1, -0.1), (30, 0, 0.1), (60, 1, -0.1), (90, 1, -0.1), (120, 1, -0.2)]
    got = A.consecutive_windows(predictions(spark, rows)).orderBy("window_start").collect()
    assert [r.confirmed for r in got] == [False, False, False, True, True]
    started = got[-1].run_started_at.replace(tzinfo=timezone.utc)
    assert started == T0 + timedelta(seconds=60) and got[1].run_started_at is None


@pytest.mark.parametrize("rows,expected", SEQUENCES[:6])
def test_cycles_equal_replay(spark, rows, expected):
    """Evaluating cycle by cycle against stored alerts gives the replay's alerts."""
    gold = spark.createDataFrame(
        [("VF-001", T0, 1.0, 1.0, 1.0, 1.0, 1.0, T0)],
        "vehicle_id STRING, window_start TIMESTAMP, avg_battery_pct DOUBLE, avg_voltage_v DOUBLE, avg_current_a DOUBLE, "
        "avg_motor_temp_c DOUBLE, rolling_5min_discharge_rate DOUBLE, aggregated_at TIMESTAMP")
    stored = []
    for n in range(len(rows)):
        alerts = spark.createDataFrame(stored, S.ALERTS)
        new = A.raise_alerts(predictions(spark, rows[: n + 1]), alerts, gold, T0 + timedelta(seconds=rows[n][0]))
        stored += [(n, r.vehicle_id, r.first_detected_at, r.run_started_at, r.anomaly_score, r.top_features, "open",
                    None, None, T0 + timedelta(seconds=rows[n][0])) for r in new.collect()]
    assert [round((s[9] - T0).total_seconds()) for s in stored] == expected
    assert all(s[5] == list(S.FEATURES[:3]) for s in stored)


def test_a_rescored_history_gives_the_same_alerts_three_ways(spark, tmp_path):
    """A vehicle goes silent, and its last window is scored again and again past the quiet time."""
    from odolake.streaming.stateful import alert_stream

    first = [(0, 1, -0.10), (30, 1, -0.11), (60, 1, -0.11)]
    again = [(60, at, -0.4) for at in (90, 3600, LATE, 2 * LATE)]
    utc = T0.timestamp()
    rows = [(w, w, score) for w, _, score in first] + again

    def history(upto):
        return spark.createDataFrame(
            [("VF-001", T0 + timedelta(seconds=w), score, True, "v1.0", "production", T0 + timedelta(seconds=t))
             for w, t, score in rows if t <= upto], S.PREDICTIONS)

    everything = history(10**6)
    assert at(A.replay_alerts(everything)) == [30]
    everything.repartition(1).write.parquet(f"{tmp_path}/p")
    stream = spark.readStream.schema(S.PREDICTIONS).parquet(f"{tmp_path}/p")
    query = alert_stream(stream).writeStream.format("memory").queryName("rescored").option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
    ended(query)
    assert at(spark.table("rescored")) == [30]
    gold = spark.createDataFrame(
        [("VF-001", T0, 1.0, 1.0, 1.0, 1.0, 1.0, T0)],
        "vehicle_id STRING, window_start TIMESTAMP, avg_battery_pct DOUBLE, avg_voltage_v DOUBLE, avg_current_a DOUBLE, "
        "avg_motor_temp_c DOUBLE, rolling_5min_discharge_rate DOUBLE, aggregated_at TIMESTAMP")
    stored = []
    for t in sorted({t for _, t, _ in rows}):
        now = T0 + timedelta(seconds=t)
        new = A.raise_alerts(history(t), spark.createDataFrame(stored, S.ALERTS), gold, now)
        stored += [(t, r.vehicle_id, r.first_detected_at, r.run_started_at, r.anomaly_score, r.top_features, "open", None, None,
                    r.created_at) for r in new.collect()]
    assert [round(s[9].replace(tzinfo=timezone.utc).timestamp() - utc) for s in stored] == [30]


def test_alerts_carried_over_micro_batches_equal_replay(spark, tmp_path):
    """A vehicle per sequence, cut into micro-batches, one of which comes twice."""
    from odolake.streaming.suppression import CarriedAlerts

    history = predictions(spark, [])
    for k, (rows, _) in enumerate(SEQUENCES):
        history = history.unionByName(predictions(spark, rows, vehicle=f"VF-{k}"))
    history = history.unionByName(predictions(spark, [(0, 1, -9.0), (30, 1, -9.0)], mode="shadow", vehicle="VF-1")).cache()
    carried, got = CarriedAlerts(spark, f"{tmp_path}/memory"), {}
    cuts = [-1, 0, 60, 60, 100, 5000, 10**6]  # the third and fourth number: a batch without rows
    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
        seconds = "unix_seconds(window_start) - " + str(int(T0.timestamp()))
        part = history.where(f"{seconds} > {low} AND {seconds} <= {high}")
        for _ in range(2 if n == 1 else 1):
            new = [tuple(r) for r in carried.update(part, n).collect()]
            assert got.setdefault(n, new) == new
    want = A.replay_alerts(history)
    assert sorted(r for new in got.values() for r in new) == sorted(tuple(r) for r in want.collect())
    assert want.count() == sum(len(expected) for _, expected in SEQUENCES)


def test_a_vehicle_silent_beyond_the_horizon_starts_anew(spark, tmp_path):
    from odolake.streaming.suppression import CarriedAlerts

    with pytest.raises(ValueError):
        CarriedAlerts(spark, f"{tmp_path}/short", suppression_hours=25, horizon_days=1)
    day = 86_400
    carried = CarriedAlerts(spark, f"{tmp_path}/memory", suppression_hours=1, horizon_days=1)
    first = predictions(spark, [(0, 1, -0.1)]).unionByName(predictions(spark, [(0, 1, -0.1)], vehicle="VF-002"))
    assert carried.update(first, 0).count() == 0
    # one vehicle's run goes on within the horizon; for the other the run is over
    second = predictions(spark, [(day, 1, -0.1)]).unionByName(
        predictions(spark, [(day + 1, 1, -0.1), (day + 2, 0, 0.1)], vehicle="VF-002"))
    assert [r.vehicle_id for r in carried.update(second, 1).collect()] == ["VF-001"]
    assert carried.update(predictions(spark, [(3 * day, 0, 0.1)], vehicle="VF-003"), 2).count() == 0
    assert [r.vehicle_id for r in carried.versions.newest().where("vehicle_id IS NOT NULL").collect()] == ["VF-003"]
    # too old to be judged
    assert carried.update(predictions(spark, [(day + 3, 1, -9.0), (day + 4, 1, -9.0)]), 3).count() == 0
    assert carried.update(first.limit(0), 4).count() == 0
