import random
from datetime import timedelta

import pytest
from conftest import NOW
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from odolake.operators import rate_limit as R


def allowed(spark, events, partitions=3, **kw):
    df = spark.createDataFrame(
        [(i, k, NOW + timedelta(seconds=t)) for i, (k, t) in enumerate(events)],
        "id BIGINT, vehicle_id STRING, received_at TIMESTAMP")
    got = {r.id: r.allowed for r in R.token_bucket(df, partitions=partitions, **kw).collect()}
    return [got[i] for i in range(len(events))]


@pytest.mark.parametrize("capacity,rate,events,expected", [
    (3, 0.25, [("a", 0)] * 3, [True] * 3),
    (2, 0.25, [("a", 0)] * 3, [True, True, False]),
    (1, 10, [("a", 0), ("a", 0), ("a", 0.15)], [True, False, True]),
    (3, 0.25, [("a", 0)] * 4 + [("b", 0)], [True, True, True, False, True]),
    (3, 0.25, [("a", t) for t in (0, 1, 2, 3, 4, 8)], [True, True, True, False, True, True]),
])
def test_known_sequences(spark, capacity, rate, events, expected):
    assert allowed(spark, events, capacity=capacity, refill_per_second=rate) == expected


def by_tokens(times, capacity, interval):
    """Plain bucket in token microseconds, one event after the other."""
    credit, last, out = capacity * interval, times[0] if times else 0, []
    for t in times:
        credit = min(capacity * interval, credit + t - last)
        last = t
        out.append(credit >= interval)
        credit -= interval if out[-1] else 0
    return out


TIMES = st.lists(st.integers(0, 400), min_size=0, max_size=60).map(sorted)


@settings(max_examples=300, deadline=None)
@given(TIMES, st.integers(1, 4), st.integers(1, 60))
def test_full_at_is_the_token_count(times, capacity, interval):
    assert R.decide(R._FULL, times, interval, (capacity - 1) * interval)[1] == by_tokens(times, capacity, interval)


@settings(max_examples=300, deadline=None)
@given(TIMES, TIMES, st.integers(1, 4), st.integers(1, 60))
def test_pieces_describe_every_opening_state(before, after, capacity, interval):
    slack = (capacity - 1) * interval
    after = [t + 400 for t in after]
    pieces = R._IDENTITY
    for t in after:
        pieces = R.extend_pieces(pieces, t, interval, slack)
    for opening in [R._FULL, R.decide(R._FULL, before, interval, slack)[0], *range(300, 700, 7)]:
        assert R.closing_state(pieces, opening) == R.decide(opening, after, interval, slack)[0]


def test_hot_key_over_many_partitions_equals_one_pass(spark):
    rng = random.Random(7)
    events = [("hot", rng.randrange(0, 3_000)) for _ in range(1500)]
    events += [(f"k{rng.randrange(60)}", rng.randrange(0, 3_000)) for _ in range(700)]
    got = allowed(spark, events, partitions=13)
    assert got == allowed(spark, events, partitions=1)
    hot = sorted((t, i) for i, (k, t) in enumerate(events) if k == "hot")
    assert [got[i] for _, i in hot] == by_tokens([t for t, _ in hot], 3, 4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=1, max_size=400), st.integers(2, 5), st.integers(1, 30), TIMES)
def test_pieces_stay_few_below_the_highest_opening_state(gaps, capacity, interval, before):
    """However many events: the opening state ends at one full bucket past the first event."""
    slack, t, pieces, times = (capacity - 1) * interval, 400, R._IDENTITY, []
    end = 400 + slack + interval + 1
    for gap in gaps:
        t += gap
        times.append(t - gaps[0])
        pieces = R.extend_pieces(pieces, times[-1], interval, slack, end)
        assert len(pieces) <= interval + 2 * capacity
    opening = R.decide(R._FULL, before, interval, slack)[0]
    assert opening < end and R.closing_state(pieces, opening) == R.decide(opening, times, interval, slack)[0]


def test_a_hot_key_is_linear():
    """A saturated bucket of one key: the summary of a partition costs a few plain passes at most."""
    import time

    interval, slack = R.bucket_times(3, 0.25)
    times = [k * 500_000 for k in range(100_000)]
    began = time.perf_counter()
    R.decide(R._FULL, times, interval, slack)
    plain = time.perf_counter() - began
    pieces, end = R._IDENTITY, times[0] + slack + interval + 1
    began = time.perf_counter()
    for t in times:
        pieces = R.extend_pieces(pieces, t, interval, slack, end)
    assert len(pieces) <= 9 and time.perf_counter() - began < max(2.0, 400 * plain)


@pytest.mark.parametrize("cuts", [(150,), (40, 41, 200), tuple(range(20, 300, 20))])
def test_batches_that_carry_their_buckets_equal_one_history(spark, tmp_path, cuts):
    """A hot key, idle keys, ties across the border of two batches, empty batches and a repeated one."""
    from odolake.streaming.limiter import CarriedBuckets

    r = random.Random(4)
    rows, t = [], 0.0
    for i in range(300):
        t += r.choice([0, 0, 0.1, 0.7, 5])
        rows.append((i, r.choice(["hot"] * 8 + ["a", "b", None]), NOW + timedelta(seconds=t)))
    events = spark.createDataFrame(rows, "id BIGINT, vehicle_id STRING, received_at TIMESTAMP")
    want = {r.id: r.allowed for r in R.token_bucket(events).collect()}
    got = {}
    for n, (a, b) in enumerate(zip((0, *cuts), (*cuts, 300))):
        batch = events.where(f"id >= {a} AND id < {b}")
        for attempt in range(2 if n == 1 else 1):  # as after a failure
            buckets = CarriedBuckets(spark, str(tmp_path / "states"), lateness_seconds=1)
            out = {x.id: x.allowed for x in buckets.decide(batch, n, partitions=4).collect()}
        got |= out
    assert got == want
    last = buckets.states.newest()
    assert last.where("key IS NOT NULL").count() <= 3 and len(buckets.states.numbers()) == min(3, len(cuts) + 1)


def test_one_key_with_most_events_is_shared_out(spark, tmp_path):
    from odolake.streaming.limiter import CarriedBuckets

    rows = spark.range(40_000).select(
        "id", F.when(F.col("id") % 10 == 0, F.format_string("k%d", F.col("id") % 700)).otherwise("hot").alias("vehicle_id"),
        F.timestamp_micros(F.lit(10**15) + F.col("id") * 1000).alias("received_at"))
    buckets = CarriedBuckets(spark, str(tmp_path / "states"))
    first = buckets.decide(rows.where("id < 20000"), 0, partitions=8)
    second = buckets.decide(rows.where("id >= 20000"), 1, partitions=8)
    sizes = [r["count"] for r in second.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 7 and max(sizes) <= 2 * sorted(sizes)[len(sizes) // 2]
    want = {tuple(r) for r in R.token_bucket(rows).collect()}
    assert {tuple(r) for r in first.unionByName(second).collect()} == want
