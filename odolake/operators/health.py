"""Health aggregates of the cleaned layer: snapshot, sliding windows, rolling rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.numeric import health_score, round_half_even
from odolake.functions.timing import MICROS, instant, minutes_between, seconds

AVERAGED = ("battery_pct", "voltage_v", "current_a", "motor_temp_c", "speed_kmh")


def discharge_rate(oldest: Column, newest: Column, first: Column, last: Column, unit_minutes: float = 1.0) -> Column:
    """Points of charge lost per time unit between two readings; 0 when no time has passed."""
    elapsed = minutes_between(last, first) / F.lit(float(unit_minutes))
    return F.when(elapsed > 0, (oldest - newest) / elapsed).otherwise(F.lit(0.0))


def _living(df: DataFrame, include_erased: bool) -> DataFrame:
    return df if include_erased else df.where(F.col("vehicle_id") != S.ERASED)


def gold_columns(start: Column, end: Column, aggregated_at: Column) -> list[Column]:
    """Final columns from the unrounded ``_m_*`` means, ``_rate`` and ``record_count``."""
    score = health_score(F.col("_m_battery_pct"), F.col("_m_motor_temp_c"), F.col("_m_voltage_v"), F.col("_rate"))
    return [
        F.col("vehicle_id"), start.alias("window_start"), end.alias("window_end"),
        *[round_half_even(F.col(f"_m_{m}"), 2).alias(f"avg_{m}") for m in AVERAGED],
        round_half_even(F.col("_rate"), 4).alias("rolling_5min_discharge_rate"),
        round_half_even(score, 1).alias("health_score"),
        F.col("record_count"), aggregated_at.alias("aggregated_at"),
    ]


def _parts(inside: Column) -> list[Column]:
    """Aggregates of the readings of a look-back: means and number of those ``inside``, and the ends of them all."""
    moment = F.struct("event_timestamp", "bronze_id")
    return [
        *[F.avg(F.when(inside, F.col(m))).alias(f"_m_{m}") for m in AVERAGED],
        F.count_if(inside).alias("record_count"),
        F.min_by("battery_pct", moment).alias("_oldest"),
        F.max_by("battery_pct", moment).alias("_newest"),
        F.min("event_timestamp").alias("_first"),
        F.max("event_timestamp").alias("_last"),
    ]


def _with_rate(grouped: DataFrame, unit_minutes: float) -> DataFrame:
    """Windows with a reading inside, with their discharge rate."""
    rate = discharge_rate(F.col("_oldest"), F.col("_newest"), F.col("_first"), F.col("_last"), unit_minutes)
    return grouped.where(F.col("record_count") > 0).withColumn("_rate", rate)


def gold_snapshot(
    silver: DataFrame, as_of, window_seconds: float = 30, lookback_seconds: float = 300,
    unit_minutes: float = 1.0, include_erased: bool = False,
) -> DataFrame:
    """One row per vehicle heard from in the window that ends at ``as_of``.

    Means cover the window, the discharge rate the longer look-back; both come from one
    aggregate with map-side partials. Lower bounds are inclusive, there is no upper bound.
    """
    now = instant(as_of)
    start = now - seconds(window_seconds)
    recent = _living(silver, include_erased).where(F.col("event_timestamp") >= now - seconds(lookback_seconds))
    grouped = _with_rate(recent.groupBy("vehicle_id").agg(*_parts(F.col("event_timestamp") >= start)), unit_minutes)
    return grouped.select(*gold_columns(start, now, now))


def gold_sliding(
    silver: DataFrame, slide_seconds: int = 30, lookback_seconds: int = 300,
    unit_minutes: float = 1.0, include_erased: bool = False,
) -> DataFrame:
    """Every aligned window of the history: means over the slide, rate over the look-back.

    Readings are first reduced to one pane per vehicle and slide. The look-back then reads
    ``lookback / slide`` panes, so its cost depends on elapsed time, not on the readings.
    """
    if lookback_seconds % slide_seconds:
        raise ValueError("the look-back must be a whole number of slides")
    back_micros = (lookback_seconds - slide_seconds) * MICROS
    moment = F.struct("event_timestamp", "bronze_id")
    micros = F.unix_micros("event_timestamp")
    start_micros = micros - F.pmod(micros, F.lit(slide_seconds * MICROS))
    pane = (
        _living(silver, include_erased).groupBy("vehicle_id", start_micros.alias("_pane"))
        .agg(
            *[F.avg(m).alias(f"_m_{m}") for m in AVERAGED],
            F.count("*").alias("record_count"),
            F.min_by(F.struct("event_timestamp", "battery_pct"), moment).alias("_head"),
            F.max_by(F.struct("event_timestamp", "battery_pct"), moment).alias("_tail"),
        )
    )
    back = Window.partitionBy("vehicle_id").orderBy("_pane").rangeBetween(-back_micros, 0)
    seen = pane.withColumn("_head", F.first("_head").over(back))
    rate = discharge_rate(
        F.col("_head.battery_pct"), F.col("_tail.battery_pct"),
        F.col("_head.event_timestamp"), F.col("_tail.event_timestamp"), unit_minutes,
    )
    start = F.timestamp_micros("_pane")
    end = F.timestamp_micros(F.col("_pane") + F.lit(slide_seconds * MICROS))
    return seen.withColumn("_rate", rate).select(*gold_columns(start, end, end))


def _cell(micros: Column, width: int) -> Column:
    """Start of the grid cell that a time in microseconds falls into."""
    return micros - F.pmod(micros, F.lit(width))


def _cells(start: Column, end: Column, width: int) -> Column:
    """Starts of the grid cells that ``[start, end)`` touches."""
    return F.sequence(_cell(start, width), _cell(end - 1, width), F.lit(width))


def windows_hit(late: DataFrame, known: DataFrame, window_seconds: int, lookback_seconds: float) -> DataFrame:
    """``vehicle_id, s, e`` (microseconds): the windows that late readings change or open, each once.

    ``known`` are the windows that exist (``vehicle_id, window_start, window_end``). A reading changes those whose
    look-back it falls into. If it lies inside none, it opens the part of its grid window that no known window
    covers, so windows opened here never overlap another one of the vehicle and no reading is counted twice.
    Both sides meet by vehicle and grid window, where a vehicle has a bounded number of look-backs, so a hot vehicle is
    spread over its history.
    """
    width, back = window_seconds * MICROS, round(lookback_seconds * MICROS)
    span = F.struct(F.unix_micros("window_start").alias("s"), F.unix_micros("window_end").alias("e"))
    since = F.least(F.col("k.s"), F.col("k.e") - F.lit(back))
    taken = known.select("vehicle_id", span.alias("k")).distinct().where("k.s < k.e").select(
        "vehicle_id", "k", F.explode(_cells(since, F.col("k.e"), width)).alias("cell")
    ).groupBy("vehicle_id", "cell").agg(F.collect_list("k").alias("taken"))
    at, cell = F.col("at"), F.col("cell")
    readings = late.select("vehicle_id", F.unix_micros("event_timestamp").alias("at")).distinct()
    met = readings.withColumn("cell", _cell(at, width)).join(taken, ["vehicle_id", "cell"], "left").withColumn(
        "taken", F.coalesce("taken", F.array().cast(taken.schema["taken"].dataType)))
    changed = F.filter("taken", lambda k: (F.least(k["s"], k["e"] - F.lit(back)) <= at) & (at < k["e"]))
    inside = F.exists("taken", lambda k: (k["s"] <= at) & (at < k["e"]))
    # greatest and least pass over what is null
    begin = F.greatest(cell, F.array_max(F.transform(F.filter("taken", lambda k: k["e"] <= at), lambda k: k["e"])))
    end = F.least(cell + F.lit(width), F.array_min(F.transform(F.filter("taken", lambda k: k["s"] > at), lambda k: k["s"])))
    opened = F.array(F.struct(begin.alias("s"), end.alias("e")))
    return met.select("vehicle_id", F.inline(F.when(inside, changed).otherwise(F.concat(changed, opened)))).distinct()


def gold_windows(silver: DataFrame, wanted: DataFrame, cell_seconds: int, lookback_seconds: float,
                 unit_minutes: float = 1.0) -> DataFrame:
    """The health rows of given windows ``wanted(vehicle_id, s, e)`` of any bounds, as ``gold_snapshot`` has them.

    A window holds its readings from ``s`` up to, but not including, ``e``. Readings meet windows by vehicle and grid
    cell and are combined before the shuffle; only readings of cells that a wanted look-back touches are copied.
    """
    width, back = cell_seconds * MICROS, round(lookback_seconds * MICROS)
    since = F.least(F.col("s"), F.col("e") - F.lit(back))
    asked = wanted.select("vehicle_id", "s", "e", since.alias("since"), F.explode(_cells(since, F.col("e"), width)).alias("cell"))
    at = F.unix_micros("event_timestamp")
    met = silver.withColumn("cell", _cell(at, width)).join(asked, ["vehicle_id", "cell"]).where(
        (at >= F.col("since")) & (at < F.col("e")))
    grouped = _with_rate(met.groupBy("vehicle_id", "s", "e").agg(*_parts(at >= F.col("s"))), unit_minutes)
    start, end = F.timestamp_micros("s"), F.timestamp_micros("e")
    return grouped.select(*gold_columns(start, end, end))


def rolling_rate(
    silver: DataFrame, lookback_seconds: int = 300, unit_minutes: float = 1.0,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Discharge rate of every reading against the oldest one in its look-back.

    An as-of search in bounded groups: each reading asks, at ``its time - look-back``, for
    the first reading from then on. Questions and readings share (vehicle, time bucket)
    groups; a reading joins the earlier bucket too when a question there may need it. A
    hot vehicle is thus spread over its buckets, and one running ``last`` in descending
    time order answers all questions of a bucket, whatever the number of readings.
    """
    look = lookback_seconds * MICROS
    width = (bucket_seconds or 4 * lookback_seconds) * MICROS
    if width < look:
        raise ValueError("a bucket must not be shorter than the look-back")
    at = F.unix_micros("event_timestamp")

    def bucket(t: Column) -> Column:
        return t - F.pmod(t, F.lit(width))

    def entry(slot: Column, time: Column, asks: int) -> Column:
        return F.struct(slot.alias("slot"), time.alias("time"), F.lit(asks).alias("asks"))

    question = entry(bucket(at - look), at - look, 1)
    here = entry(bucket(at), at, 0)
    earlier = entry(bucket(at - look), at, 0)
    entries = (
        silver.select(
            "vehicle_id", "bronze_id", "event_timestamp", "battery_pct",
            F.explode(
                F.when(bucket(at - look) < bucket(at), F.array(question, here, earlier))
                .otherwise(F.array(question, here))
            ).alias("_e"),
        ).select("*", "_e.*")
    )
    w = (
        Window.partitionBy("vehicle_id", "slot")
        .orderBy(F.desc("time"), "asks", F.desc("bronze_id"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    reading = F.when(F.col("asks") == 0, F.struct("event_timestamp", "battery_pct"))
    answered = entries.withColumn("_old", F.last(reading, ignorenulls=True).over(w)).where("asks = 1")
    rate = discharge_rate(
        F.col("_old.battery_pct"), F.col("battery_pct"),
        F.col("_old.event_timestamp"), F.col("event_timestamp"), unit_minutes,
    )
    return answered.select(
        "bronze_id", "vehicle_id", "event_timestamp", "battery_pct", rate.alias("discharge_rate")
    )
