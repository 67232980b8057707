import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from odolake.session import local_session  # noqa: E402

NOW = datetime(2031, 3, 9, 14, 45, 0, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def no_stream_outlives_its_test(request):
    yield
    if "spark" in request.fixturenames:
        for query in request.getfixturevalue("spark").streams.active:
            query.stop()


def ended(query, seconds: int = 180) -> None:
    """Wait for a stream that has to end by itself, without an error."""
    assert query.awaitTermination(seconds) is True
    assert query.exception() is None


def ago(**kw) -> datetime:
    return NOW - timedelta(**kw)


def vehicle_rows(spark, *ids):
    return spark.createDataFrame(
        [(v, 2019, 58.0, "NORTH") for v in ids],
        "vehicle_id STRING, manufacture_year INT, rated_capacity_kwh DOUBLE, region STRING",
    )


# readings a test does not care about
FILL = {"state_of_charge_kwh": 21.5, "voltage_v": 288.25, "current_a": 11.75, "motor_temp_c": 36.5,
        "latitude": 47.3125, "longitude": 8.55, "speed_kmh": 17.0}


def bronze_rows(spark, rows):
    """rows: (id, vehicle, time, battery[, overrides])"""
    from odolake import schemas as S

    out = []
    for ident, vehicle, at, battery, *extra in rows:
        r = {"id": ident, "vehicle_id": vehicle, "event_timestamp": at, "received_at": at, "battery_pct": battery,
             **FILL, "regen_braking_event": False, "raw_payload": "{}", **(extra[0] if extra else {})}
        out.append(tuple(r[n] for n in S.BRONZE.names))
    return spark.createDataFrame(out, S.BRONZE)


def silver_rows(spark, rows):
    from odolake.operators import cleaning

    ids = {r[1] for r in rows}
    return cleaning.silver(bronze_rows(spark, rows), vehicle_rows(spark, *ids))
