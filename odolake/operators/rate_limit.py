"""Token bucket per key over a whole history, exact and split by time as well as by key.

The bucket is kept as the instant at which it will be full again (``full_at``), in whole
microseconds. With ``interval`` = time to earn one token and ``slack`` = time to earn all
but one, an event at ``t`` is allowed when ``full_at <= t + slack``; it then moves
``full_at`` to ``max(full_at, t) + interval``.

Events are range-partitioned by (key, time, id), so a hot key spreads over as many
partitions as its rows need. Only the first key of a partition can have begun in an
earlier one. A first pass describes, for that key, the closing state as a function of the
unknown opening state. That state lies at most ``capacity`` intervals past the partition's
first event, as an event can push it no further, so a busy key needs about ``capacity``
pieces (shifted by a whole number of intervals, or constant), however many events there are.
A bucket of one token, or an idle key, may need one more per event of one interval. The pieces, at most one row per partition, are chained, and a second pass
decides every event with its true opening state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.functions.timing import MICROS
from odolake.session import pinned

_FULL = -(2**62)  # "has always been full"
_END = 2**62
_IDENTITY = [(_FULL, False, 0)]
EVENTS_PER_PARTITION = 500_000


def step(full_at: int, t: int, interval: int, slack: int) -> tuple[int, bool]:
    """State after one event, and whether it was allowed."""
    if full_at <= t:
        return t + interval, True
    if full_at <= t + slack:
        return full_at + interval, True
    return full_at, False


def decide(full_at: int, times: list[int], interval: int, slack: int) -> tuple[int, list[bool]]:
    """State and decisions after events in time order."""
    allowed = []
    for t in times:
        if full_at > t + slack:
            allowed.append(False)
            continue
        full_at = (full_at if full_at > t else t) + interval
        allowed.append(True)
    return full_at, allowed


def extend_pieces(pieces: list, t: int, interval: int, slack: int, end: int = _END) -> list:
    """Carry the opening-to-closing state function over one more event.

    A piece ``(low, constant, value)`` covers opening states from ``low`` up to the next
    piece, the last one up to ``end``; its closing state is ``value`` if constant, else the
    opening state + ``value``.
    """
    out: list = []

    def add(low: int, constant: bool, value: int) -> None:
        if not out or out[-1][1:] != (constant, value):
            out.append((low, constant, value))

    for i, (low, constant, value) in enumerate(pieces):
        high = pieces[i + 1][0] if i + 1 < len(pieces) else end
        if constant:
            add(low, True, step(value, t, interval, slack)[0])
            continue
        full = min(max(t - value + 1, low), high)
        spend = min(max(t + slack - value + 1, full), high)
        if low < full:
            add(low, True, t + interval)
        if full < spend:
            add(full, False, value + interval)
        if spend < high:
            add(spend, False, value)
    return out


def closing_state(pieces: list, opening: int) -> int:
    """Evaluate the function described by ``pieces``."""
    for low, constant, value in reversed(pieces):
        if opening >= low:
            return value if constant else opening + value
    raise ValueError("opening state below every piece")


def _runs(batch: pa.RecordBatch) -> list[tuple[str, int | None, list[int]]]:
    """Consecutive rows of the same key in a sorted batch, as (key, state it begins with, times of its events)."""
    keys = batch.column(0).to_numpy(zero_copy_only=False)
    times = batch.column(1).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        given = batch.column(3)[a].as_py() if times[a] == _FULL else None  # a state sorts before all events
        out.append((keys[a], given, times[a if given is None else a + 1:b]))
    return out


_SUMMARY = "part INT, first_key STRING, last_key STRING, lows ARRAY<BIGINT>, " \
           "constants ARRAY<BOOLEAN>, vals ARRAY<BIGINT>, tail BIGINT"


def _summariser(interval: int, slack: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = current = None
        pieces, tail, end = _IDENTITY, _FULL, _END
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = _runs(batch)
            for n, (key, given, times) in enumerate(runs):
                if key != current:
                    if first is not None and n < len(runs) - 1:
                        continue  # begins and ends here: no neighbour needs its state
                    current, tail = key, _FULL if given is None else given
                    if first is None:
                        first = key
                        pieces = _IDENTITY if given is None else [(_FULL, True, given)]
                times = times.tolist()
                if end == _END and times:
                    end = times[0] + slack + interval + 1
                if current != first:
                    tail, _ = decide(tail, times, interval, slack)
                    continue
                for i, t in enumerate(times):
                    if len(pieces) == 1 and pieces[0][1]:  # opening state no longer matters
                        state, _ = decide(pieces[0][2], times[i:], interval, slack)
                        pieces = [(_FULL, True, state)]
                        break
                    pieces = extend_pieces(pieces, t, interval, slack, end)
        if first is not None:
            low, constant, value = (list(c) for c in zip(*pieces))
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                 "first_key": [first], "last_key": [current],
                 "lows": pa.array([low], pa.list_(pa.int64())),
                 "constants": pa.array([constant], pa.list_(pa.bool_())),
                 "vals": pa.array([value], pa.list_(pa.int64())),
                 "tail": pa.array([tail], pa.int64())})

    return summarise


def _opening_states(summaries: list) -> dict[int, int]:
    """Opening state of the first key of every partition that continues an earlier one."""
    opening: dict[int, int] = {}
    key, state = None, _FULL
    for row in sorted(summaries, key=lambda r: r.part):
        start = state if row.first_key == key else _FULL
        if start != _FULL:
            opening[row.part] = start
        if row.last_key == row.first_key:
            state = closing_state(list(zip(row.lows, row.constants, row.vals)), start)
        else:
            state = row.tail
        key = row.last_key
    return opening


def _decider(interval: int, slack: int, opening: dict[int, int]):
    """Decides every event; the last row of a run of one key also names the key and its state then."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = opening.get(TaskContext.get().partitionId(), _FULL)
        current, started = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            verdicts: list[bool] = []
            keys: list[str | None] = []
            states: list[int | None] = []
            for key, given, times in _runs(batch):
                if key != current:
                    state = _FULL if started else state
                    current, started = key, True
                if given is not None:
                    state = given
                    verdicts.append(False)
                state, allowed = decide(state, times.tolist(), interval, slack)
                verdicts += allowed
                keys += [None] * (len(verdicts) - len(keys) - 1) + [key]
                states += [None] * (len(verdicts) - len(states) - 1) + [state]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(verdicts, pa.bool_()), pa.array(keys, pa.string()), pa.array(states, pa.int64())],
                names=["id", "allowed", "key", "full_at"])

    return run


def bucket_times(capacity: int, refill_per_second: float) -> tuple[int, int]:
    """(interval, slack) in microseconds for a bucket of ``capacity`` tokens."""
    interval = round(MICROS / refill_per_second)
    return interval, (capacity - 1) * interval


def _arrivals(events: DataFrame, key: str, time: str, ident: str) -> DataFrame:
    return events.where(F.col(key).isNotNull()).select(
        F.col(key).alias("key"), F.unix_micros(time).alias("t"), F.col(ident).alias("id"),
        F.lit(None).cast("bigint").alias("full_at"))


def _decided(arrivals: DataFrame, interval: int, slack: int, partitions: int | None) -> DataFrame:
    """``id, allowed`` of every event, and ``key, full_at`` where a run of one key ends."""
    spark = arrivals.sparkSession
    width = partitions or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), -(-arrivals.count() // EVENTS_PER_PARTITION))
    ordered = pinned(arrivals.repartitionByRange(width, "key", "t", "id").sortWithinPartitions("key", "t", "id"))
    summaries = ordered.mapInArrow(_summariser(interval, slack), _SUMMARY).collect()  # one row per partition
    return ordered.mapInArrow(
        _decider(interval, slack, _opening_states(summaries)), "id BIGINT, allowed BOOLEAN, key STRING, full_at BIGINT")


def token_bucket(
    events: DataFrame, key: str = "vehicle_id", time: str = "received_at", ident: str = "id",
    capacity: int = 3, refill_per_second: float = 0.25, partitions: int | None = None,
) -> DataFrame:
    """(id, allowed) for every event with a key; every bucket starts full.

    Only the three columns needed are sorted; join the answer back on the unique id. The
    number of partitions follows the number of events.
    """
    interval, slack = bucket_times(capacity, refill_per_second)
    return _decided(_arrivals(events, key, time, ident), interval, slack, partitions).select("id", "allowed")


def token_bucket_step(
    events: DataFrame, states: DataFrame, path: str, key: str = "vehicle_id", time: str = "received_at",
    ident: str = "id", capacity: int = 3, refill_per_second: float = 0.25, partitions: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """One batch of a longer history: (id, allowed) of its events, and ``key, full_at`` of all buckets after it.

    ``states`` are the buckets before it. A state is one more row of its key, sorted before the events, so
    a hot key is split over partitions here as well, and nothing is joined. The decisions are
    written to ``path``, which both results read.
    """
    interval, slack = bucket_times(capacity, refill_per_second)
    before = states.select("key", F.lit(_FULL).alias("t"), F.lit(None).cast("bigint").alias("id"), "full_at")
    rows = _decided(_arrivals(events, key, time, ident).unionByName(before), interval, slack, partitions)
    rows.write.mode("overwrite").parquet(path)
    rows = events.sparkSession.read.schema(rows.schema).parquet(path)
    after = rows.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("full_at").alias("full_at"))  # it never falls
    return rows.where(F.col("id").isNotNull()).select("id", "allowed"), after
