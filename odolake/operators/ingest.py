"""Routing of inspected events to the raw layer and the dead-letter table, and its metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.operators.validation import OVERSIZE

ACCEPTED = "accepted"
RATE_LIMITED = "rejected_rate_limit"
INVALID = "rejected_validation"
TOO_LARGE = "rejected_too_large"


def outcome(allowed: Column | None = None) -> Column:
    """What happens to an inspected event. ``allowed`` is the limiter's answer, if one ran.

    Oversize and rate-limited events are dropped; the others that fail are dead-lettered.
    The limiter is charged before the field checks, so a limited event is not invalid too.
    """
    limited = ~F.coalesce(allowed, F.lit(True)) if allowed is not None else F.lit(False)
    return (
        F.when(F.col("entry_reason") == OVERSIZE, TOO_LARGE)
        .when(F.col("entry_reason").isNotNull(), INVALID)
        .when(limited, RATE_LIMITED)
        .when(F.col("reason").isNotNull(), INVALID)
        .otherwise(ACCEPTED)
    )


def accepted_rows(routed: DataFrame) -> DataFrame:
    """Rows for the raw layer, typed and with their payload kept word for word."""
    return routed.where(F.col("outcome") == ACCEPTED).select(
        *[F.col(f.name).cast(f.dataType) for f in S.BRONZE.fields]
    )


def dead_letters(routed: DataFrame) -> DataFrame:
    """Rows for the dead-letter table, with the structured reason."""
    client = F.col("client_ip") if "client_ip" in routed.columns else F.lit(None).cast("string")
    return routed.where(F.col("outcome") == INVALID).select(
        "id", "received_at", F.coalesce("raw_payload", F.lit("")).alias("raw_payload"),
        F.col("reason").alias("error_reason"), client.alias("client_ip"),
    )


def outcome_counts(routed: DataFrame) -> DataFrame:
    return routed.groupBy("outcome").agg(F.count("*").alias("events"))


def ingest_metrics(routed: DataFrame) -> DataFrame:
    """One row: accepted, refused by limit, refused by validation, dead letters, raw rows."""
    def tally(name: str) -> Column:
        return F.count_if(F.col("outcome") == name)

    return routed.agg(
        tally(ACCEPTED).alias("events_accepted"),
        tally(RATE_LIMITED).alias("events_rejected_rate_limit"),
        tally(INVALID).alias("events_rejected_validation"),
        tally(INVALID).alias("dlq_depth"),
        tally(ACCEPTED).alias("bronze_record_count"),
    )


def dlq_newest(dlq: DataFrame, limit: int = 100, preview: int = 200) -> DataFrame:
    """Newest dead letters with the start of their payload."""
    return (
        dlq.select("id", "received_at", "error_reason", "client_ip",
                   F.substring("raw_payload", 1, preview).alias("raw_preview"))
        .orderBy(F.desc("received_at"), F.desc("id"))
        .limit(limit)
    )


def events_per_minute(events: DataFrame, column: str = "received_at", width: str = "1 minute") -> DataFrame:
    """Arrivals per aligned time slot."""
    return (
        events.groupBy(F.window(column, width).alias("slot"))
        .agg(F.count("*").alias("events"))
        .select(F.col("slot.start").alias("slot_start"), "events")
    )
