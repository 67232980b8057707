"""Time expressions. Nothing here reads the clock unless the caller passes no ``as_of``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def instant(as_of: str | datetime | None) -> Column:
    """A timestamp literal; the current time when ``as_of`` is None."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, datetime):
        moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
        return F.timestamp_micros(F.lit(round(moment.timestamp() * MICROS)))
    return F.to_timestamp(F.lit(as_of))


def seconds(amount: float) -> Column:
    """A day-time interval of ``amount`` seconds."""
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(amount).cast("decimal(18,6)"))


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60.0 * MICROS)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL when it is none.

    Takes the extended form (date only, ``Z``, offsets, fractions) and the basic form
    ``20260607T120000``. A text without offset is UTC. Week dates are not accepted.
    """
    # the common full form needs no rewriting; the others are tried only where it fails
    full = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$"), F.try_to_timestamp(text)
    )
    extended = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"),
        F.try_to_timestamp(
            F.regexp_replace(
                F.regexp_replace(
                    F.regexp_replace(F.regexp_replace(text, ",", "."), r"([+-]\d{2})(\d{2})$", "$1:$2"),
                    r"(:.*[+-]\d{2})$", "$1:00",
                ),
                r"^(.{10}[T ]\d{2})(Z|[+-]\d{2}(:\d{2})?)?$", "$1:00$2",
            )
        ),
    )
    stamp = F.regexp_replace(text, "[TZ]", "")
    basic = F.coalesce(
        F.when(text.rlike(r"^\d{8}T\d{6}Z?$"), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmmss"))),
        F.when(text.rlike(r"^\d{8}T\d{4}Z?$"), F.try_to_timestamp(stamp, F.lit("yyyyMMddHHmm"))),
        F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(stamp, F.lit("yyyyMMdd"))),
    )
    return F.coalesce(full, extended, basic)


def lag_seconds(last: Column, as_of: Column) -> Column:
    """Age in whole seconds, ties to even."""
    return F.rint((F.unix_micros(as_of) - F.unix_micros(last)) / F.lit(float(MICROS))).cast("long")


def stage_status(last: Column, as_of: Column, stale_after_seconds: float) -> Column:
    """``no_data``, ``ok`` or ``stale`` for a stage whose newest output is ``last``."""
    age = (F.unix_micros(as_of) - F.unix_micros(last)) / F.lit(float(MICROS))
    return (
        F.when(last.isNull(), "no_data")
        .when(age < F.lit(float(stale_after_seconds)), "ok")
        .otherwise("stale")
    )
