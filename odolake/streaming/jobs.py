"""The layers as streaming queries. Each is its own query with its own checkpoint.

A stage reads the table the stage before it writes, so a stage that stops leaves the ones
after it idle and the ones before it running.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from odolake import schemas as S
from odolake.functions.timing import seconds
from odolake.operators import cleaning, forest, health, ingest, validation
from odolake.operators.alerting import with_causes
from odolake.session import pinned, spread
from odolake.sources.store import Store, with_batch_ids
from odolake.sources.latest_table import LatestTable
from odolake.streaming.limiter import CarriedBuckets
from odolake.streaming.panes import CarriedPanes
from odolake.streaming.suppression import CarriedAlerts


class CircuitOpen(RuntimeError):
    """Too large a share of a micro-batch failed; its offsets stay uncommitted."""


def raw_text(spark: SparkSession, folder: str, arrival: Column | None = None, **options: str) -> DataFrame:
    """One JSON event per line, text kept word for word, with its time of arrival."""
    reader = spark.readStream
    for key, value in options.items():
        reader = reader.option(key, value)
    lines = reader.text(folder)
    return lines.select(
        F.col("value").alias("raw_payload"), (F.current_timestamp() if arrival is None else arrival).alias("received_at")
    )


def _start(writer: DataStreamWriter, checkpoint: str, interval: str | None) -> StreamingQuery:
    """Every ``interval``, or once over what is there when it is None."""
    timed = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return timed.option("checkpointLocation", checkpoint).start()


def ingest_query(events: DataFrame, store: Store, checkpoint: str, interval: str | None = "30 seconds",
                 capacity: int | None = 3, refill_per_second: float = 0.25, lateness_seconds: float = 60,
                 **rules) -> StreamingQuery:
    """Limit and validate, then write accepted and refused events as two outputs of one micro-batch.

    A payload is parsed once. Events are numbered as they arrive and then dealt out, as a file of few row groups is
    read by few tasks. The limiter sees key, time and number of an event only, and the numbers it
    refuses travel back. Events over the limit are dropped, not dead-lettered; ``capacity=None`` switches
    the limiter off.
    """
    buckets = None if capacity is None else CarriedBuckets(
        events.sparkSession, f"{checkpoint}/buckets", capacity, refill_per_second, lateness_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = with_batch_ids(batch, batch_id)
        inspected = pinned(validation.inspect(spread(numbered, "id"), **rules))
        allowed = None
        if buckets is not None:
            verdicts = buckets.decide(inspected, batch_id, key="limiter_key")
            inspected = inspected.join(verdicts.where(~F.col("allowed")), "id", "left")
            allowed = F.col("allowed")
        routed = inspected.withColumn("outcome", ingest.outcome(allowed))
        store.write_batch("bronze_telemetry", ingest.accepted_rows(routed), batch_id)
        store.write_batch("bronze_dlq", ingest.dead_letters(routed), batch_id)

    return _start(events.writeStream.foreachBatch(write), checkpoint, interval)


def limit_query(events: DataFrame, out: str, checkpoint: str, interval: str | None = "30 seconds",
                key: str = "vehicle_id", time: str = "received_at", ident: str = "id", **bucket) -> StreamingQuery:
    """(id, allowed) of every event as Parquet, a folder per micro-batch."""
    buckets = CarriedBuckets(events.sparkSession, f"{checkpoint}/buckets", **bucket)

    def write(batch: DataFrame, batch_id: int) -> None:
        verdicts = buckets.decide(batch, batch_id, key, time, ident)
        verdicts.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(events.writeStream.foreachBatch(write), checkpoint, interval)


def silver_query(store: Store, checkpoint: str, interval: str | None = "30 seconds",
                 threshold: float = S.BREAKER_THRESHOLD, on_trip: str = "fail", latest: LatestTable | None = None,
                 **options: str) -> StreamingQuery:
    """Clean new raw rows. An open breaker fails the batch, or sets the whole batch aside.

    ``latest`` is kept up to date with the cleaned rows, for readers of the newest state.

    The size of a micro-batch is bounded by the source options ``maxFilesPerTrigger`` and
    ``maxBytesPerTrigger``; the checkpoint is the progress mark.
    """
    if on_trip not in ("fail", "quarantine"):
        raise ValueError(f"on_trip must be 'fail' or 'quarantine', not {on_trip!r}")

    def write(batch: DataFrame, batch_id: int) -> None:
        named = batch.where(F.col("vehicle_id") != S.ERASED)  # erased before it was read
        rows = pinned(cleaning.assess(named, store.read("vehicle_metadata")))
        summary = cleaning.batch_summary(rows, threshold, by=None).first()
        now = F.current_timestamp()
        if summary.circuit_open:
            if on_trip == "fail":
                raise CircuitOpen(f"{summary.records_failed} of {summary.records_read} records failed")
            rows = rows.withColumn("skip_reason", F.coalesce("skip_reason", F.lit("batch_quarantined")))
        cleaned = cleaning.cleaned_rows(rows, now)
        store.write_batch("silver_telemetry", cleaned, batch_id)
        store.write_batch("silver_rejects", cleaning.rejected_rows(rows, now), batch_id)
        if latest is not None:
            latest.update(cleaned, batch_id)

    return _start(store.stream("bronze_telemetry", **options).writeStream.foreachBatch(write), checkpoint, interval)


def gold_stream(silver: DataFrame, slide_seconds: int = 30, lookback_seconds: int = 300,
                unit_minutes: float = 1.0, lateness: str = "1 minute") -> DataFrame:
    """Sliding health aggregate with a watermark; final rows only, one shuffle, no join.

    Windows span the look-back and end on the slide grid. Inside one aggregate the means
    take only the last slide; windows without a reading there are dropped.
    """
    end = F.col("w.end")
    inside = F.col("event_timestamp") >= end - seconds(slide_seconds)
    moment = F.struct("event_timestamp", "bronze_id")
    windowed = (
        silver.where(F.col("vehicle_id") != S.ERASED)
        .withWatermark("event_timestamp", lateness)
        .withColumn("w", F.window("event_timestamp", f"{lookback_seconds} seconds", f"{slide_seconds} seconds"))
    )
    grouped = (
        windowed.groupBy("w", "vehicle_id")
        .agg(
            *[F.avg(F.when(inside, F.col(m))).alias(f"_m_{m}") for m in health.AVERAGED],
            F.count_if(inside).alias("record_count"),
            F.min_by("battery_pct", moment).alias("_oldest"), F.max_by("battery_pct", moment).alias("_newest"),
            F.min("event_timestamp").alias("_first"), F.max("event_timestamp").alias("_last"),
        )
        .where(F.col("record_count") > 0)
    )
    rate = health.discharge_rate(F.col("_oldest"), F.col("_newest"), F.col("_first"), F.col("_last"), unit_minutes)
    return grouped.withColumn("_rate", rate).select(
        *health.gold_columns(end - seconds(slide_seconds), end, end)
    )


def gold_query(store: Store, checkpoint: str, interval: str | None = "30 seconds", slide_seconds: int = 30,
               lookback_seconds: int = 300, unit_minutes: float = 1.0, lateness_seconds: float = 60,
               **options: str) -> StreamingQuery:
    """Append the windows that each micro-batch closes, and set the readings aside that are too late for theirs."""
    carried = CarriedPanes(
        store.spark, f"{checkpoint}/panes", slide_seconds, lookback_seconds, unit_minutes, lateness_seconds)

    def write(batch: DataFrame, batch_id: int) -> None:
        closed, late = carried.update(pinned(batch), batch_id)
        store.write_batch("gold_vehicle_health", closed, batch_id)
        store.write_batch("silver_late", late, batch_id)

    return _start(store.stream("silver_telemetry", **options).writeStream.foreachBatch(write), checkpoint, interval)


def status_stream(events: DataFrame, silent_seconds: int = 120, lateness: str = "1 minute", time: str = "received_at"
                  ) -> DataFrame:
    """``vehicle_id, online_at, offline_at``: the spells in which a vehicle was heard from without a longer silence.

    A vehicle goes off line ``silent_seconds`` after the last event of a spell. Session windows are merged in
    each task before the shuffle, so a busy vehicle sends one session per task; the state holds open
    spells only, and a spell comes out once the watermark has passed its end.
    """
    named = events.where(F.col("vehicle_id").isNotNull() & (F.col("vehicle_id") != S.ERASED))
    spell = F.session_window(time, f"{silent_seconds} seconds")
    spells = named.withWatermark(time, lateness).groupBy("vehicle_id", spell.alias("spell")).agg(F.count("*").alias("events"))
    return spells.select("vehicle_id", F.col("spell.start").alias("online_at"), F.col("spell.end").alias("offline_at"), "events")


def transitions(spells: DataFrame) -> DataFrame:
    """``vehicle_id, at, status``: the moments at which vehicles go on and off line."""
    both = F.array(F.struct(F.col("online_at").alias("at"), F.lit("online").alias("status")),
                   F.struct(F.col("offline_at").alias("at"), F.lit("offline").alias("status")))
    return spells.select("vehicle_id", F.inline(both))


def predict_query(store: Store, checkpoint: str, live: forest.Forest, candidate: forest.Forest | None = None,
                  interval: str | None = "30 seconds") -> StreamingQuery:
    """Score every new health row; a candidate model scores the same rows in shadow mode."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = pinned(batch.where(F.col("vehicle_id") != S.ERASED))

        def mode(model: forest.Forest, name: str) -> DataFrame:
            # the window's end stands for the cycle, so that a retried batch writes the same rows
            return forest.predictions(rows, model, name, F.col("window_end"))

        out = mode(live, "production")
        if candidate is not None:
            out = out.unionByName(mode(candidate, "shadow"))
        store.write_batch("predictions", out, batch_id)

    return _start(store.stream("gold_vehicle_health").writeStream.foreachBatch(write), checkpoint, interval)


def alert_query(store: Store, checkpoint: str, interval: str | None = "30 seconds", predictions: DataFrame | None = None,
                horizon_days: float = 30, **rules) -> StreamingQuery:
    """Raise alerts from new production predictions, with the features that stand out most.

    Run lengths and last alerts are carried along, one row per vehicle of the last ``horizon_days``; the features come
    from the health rows of the same time before the micro-batch's oldest alert. ``predictions`` stands
    for the store's own.
    """
    carried = CarriedAlerts(store.spark, f"{checkpoint}/suppression", horizon_days=horizon_days, **rules)

    def write(batch: DataFrame, batch_id: int) -> None:
        raised = pinned(carried.update(batch, batch_id))
        oldest = raised.agg(F.unix_micros(F.min("created_at")).alias("t")).first().t
        since = None if oldest is None else (
            datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=oldest) - timedelta(days=horizon_days))
        named = with_causes(raised, store.current("gold_vehicle_health", since=since)) if since else raised
        store.write_batch("alerts", with_batch_ids(named, batch_id), batch_id)

    source = store.stream("predictions") if predictions is None else predictions
    return _start(source.writeStream.foreachBatch(write), checkpoint, interval)
