"""Alerts from predictions: consecutive anomalous windows, suppression, feature attribution.

Alerting first reduces predictions to one row per vehicle and window. From there on the
rows of a vehicle are bounded by elapsed time over window length, however many rows the
raw layers hold for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.numeric import relative_deviation, worsened
from odolake.functions.timing import MICROS, instant, seconds
from odolake.operators.latest import newest_row, top_n_per_key

PRODUCTION = "production"


def one_per_window(predictions: DataFrame, mode: str = PRODUCTION, include_erased: bool = False) -> DataFrame:
    """The first prediction of each vehicle and window: a window that is scored again counts once, as it did first.

    Replay, cycles and streams share this rule, so a history that was scored repeatedly gives
    the same alerts in all three.
    """
    kept = predictions.where(F.col("mode") == mode)
    if not include_erased:
        kept = kept.where(F.col("vehicle_id") != S.ERASED)
    order = F.struct("predicted_at", "anomaly_score")
    return kept.groupBy("vehicle_id", "window_start").agg(
        F.min("predicted_at").alias("predicted_at"),
        F.min_by("anomaly_score", order).alias("anomaly_score"),
        F.min_by("is_anomaly", order).alias("is_anomaly"),
    )


def consecutive_windows(predictions: DataFrame, consecutive: int = 2, mode: str = PRODUCTION) -> DataFrame:
    """Mark windows that end a run of at least ``consecutive`` anomalous ones.

    ``run_started_at`` is the first window of the current anomalous run.
    """
    by_time = Window.partitionBy("vehicle_id").orderBy("window_start")
    recent = by_time.rowsBetween(-(consecutive - 1), 0)
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    rows = one_per_window(predictions, mode)
    marked = rows.select(
        "*",
        (F.every("is_anomaly").over(recent) & (F.count("*").over(recent) == consecutive)).alias("confirmed"),
        (F.col("is_anomaly") & ~F.coalesce(F.lag("is_anomaly").over(by_time), F.lit(False))).alias("_new_run"),
    )
    start = F.last(F.when(F.col("_new_run"), F.col("window_start")), ignorenulls=True).over(so_far)
    return marked.withColumn("run_started_at", F.when(F.col("is_anomaly"), start)).drop("_new_run")


def _suppress(candidates: Column, factor: float, quiet_micros: int) -> Column:
    """Fold candidates in time order; keep those that raise an alert.

    A candidate is silent while the last alert is at most ``quiet`` old, unless its score
    is worse than ``factor`` times that alert's score.
    """
    start = F.struct(
        F.lit(None).cast("bigint").alias("at"), F.lit(None).cast("double").alias("score"),
        F.filter(candidates, lambda c: F.lit(False)).alias("raised"),
    )

    def fold(acc: Column, c: Column) -> Column:
        fires = (
            acc["at"].isNull()
            | (acc["at"] < c["at"] - F.lit(quiet_micros))
            | worsened(c["anomaly_score"], acc["score"], factor)
        )
        return F.when(
            fires,
            F.struct(c["at"].alias("at"), c["anomaly_score"].alias("score"),
                     F.concat(acc["raised"], F.array(c)).alias("raised")),
        ).otherwise(acc)

    return F.aggregate(candidates, start, fold, lambda acc: acc["raised"])


def replay_alerts(
    predictions: DataFrame, consecutive: int = 2, suppression_hours: float = 4, factor: float = 1.2,
    mode: str = PRODUCTION,
) -> DataFrame:
    """All alerts a prediction history gives rise to, in one job.

    Candidates further than the quiet time from the one before always alert, whatever
    happened earlier, so each such episode is folded on its own.
    """
    quiet = round(suppression_hours * 3600 * MICROS)
    by_time = Window.partitionBy("vehicle_id").orderBy("predicted_at", "window_start")
    at = F.unix_micros("predicted_at")
    candidates = (
        consecutive_windows(predictions, consecutive, mode).where("confirmed")
        .withColumn("at", at)
        .withColumn("_fresh", F.coalesce(F.col("at") - F.lag("at").over(by_time) > F.lit(quiet), F.lit(True)))
        .withColumn("_episode", F.count_if("_fresh").over(by_time))
    )
    row = F.struct("at", "window_start", "predicted_at", "anomaly_score", "run_started_at")
    folded = candidates.groupBy("vehicle_id", "_episode").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    return folded.select(
        "vehicle_id", F.explode(_suppress(F.col("_rows"), factor, quiet)).alias("_a")
    ).select(
        "vehicle_id", F.col("_a.window_start").alias("first_detected_at"), F.col("_a.run_started_at"),
        F.col("_a.anomaly_score"), F.lit("open").alias("status"), F.col("_a.predicted_at").alias("created_at"),
    )


# --- one evaluation cycle -----------------------------------------------------


def confirmed_now(predictions: DataFrame, consecutive: int = 2, mode: str = PRODUCTION) -> DataFrame:
    """Vehicles whose newest ``consecutive`` windows are all anomalous, with the newest one."""
    recent = top_n_per_key(one_per_window(predictions, mode), "vehicle_id", [F.desc("window_start")], consecutive)
    newest = F.col("window_start")
    return (
        recent.groupBy("vehicle_id")
        .agg(
            F.count("*").alias("_n"), F.every("is_anomaly").alias("_all"),
            F.max("window_start").alias("window_start"), F.min("window_start").alias("run_started_at"),
            F.max_by("anomaly_score", newest).alias("anomaly_score"),
            F.max_by("predicted_at", newest).alias("predicted_at"),
        )
        .where((F.col("_n") == consecutive) & F.col("_all"))
        .drop("_n", "_all")
    )


def raise_alerts(
    predictions: DataFrame, alerts: DataFrame, gold: DataFrame, as_of, consecutive: int = 2,
    suppression_hours: float = 4, factor: float = 1.2, mode: str = PRODUCTION, top: int = 3,
) -> DataFrame:
    """New alerts of the cycle at ``as_of``, given the stored predictions and open alerts.

    A window is judged at the time of its first prediction: scoring it again later, as happens
    to a vehicle that went silent, neither raises it anew nor outlives the quiet time.
    """
    now = instant(as_of)
    standing = newest_row(
        alerts.where(F.col("status") == "open").select(
            "vehicle_id", "id", F.col("created_at").alias("_at"), F.col("anomaly_score").alias("_score")),
        "vehicle_id", ["_at", "id"], ["_at", "_score"],
    )
    quiet_since = F.col("predicted_at") - seconds(suppression_hours * 3600)
    due = (
        confirmed_now(predictions.where(F.col("predicted_at") <= now), consecutive, mode)
        .join(standing, "vehicle_id", "left")
        .where(F.col("_at").isNull() | (F.col("_at") < quiet_since)
               | worsened(F.col("anomaly_score"), F.col("_score"), factor))
    )
    return with_causes(due.select(
        "vehicle_id", F.col("window_start").alias("first_detected_at"), "run_started_at", "anomaly_score",
        F.lit("open").alias("status"), F.lit(None).cast("timestamp").alias("acknowledged_at"),
        F.lit(None).cast("string").alias("acknowledged_by"), F.col("predicted_at").alias("created_at"),
    ), gold, top)


def with_causes(alerts: DataFrame, gold: DataFrame, top: int = 3) -> DataFrame:
    """``alerts`` with ``top_features``: what stands out in the newest health row of the vehicle."""
    named = alerts.join(top_features(gold, top=top), "vehicle_id", "left")
    causes = F.coalesce("top_features", F.array().cast("array<string>")).alias("top_features")
    return named.select(*alerts.columns, causes)


# --- attribution --------------------------------------------------------------


def newest_health(gold: DataFrame, features: Sequence[str] = S.FEATURES, include_erased: bool = False) -> DataFrame:
    """One health row per vehicle, the newest by aggregation time."""
    kept = gold if include_erased else gold.where(F.col("vehicle_id") != S.ERASED)
    return newest_row(kept, "vehicle_id", ["aggregated_at", "window_start"],
                      ["aggregated_at", "window_start", *features])


def fleet_means(gold: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """One row: mean of each feature over the newest row of every vehicle."""
    return newest_health(gold, features).agg(*[F.avg(f).alias(f) for f in features])


def top_features(gold: DataFrame, features: Sequence[str] = S.FEATURES, top: int = 3) -> DataFrame:
    """Per vehicle the features furthest from the fleet mean; ties keep the feature order.

    The fleet means reach the rows as a scalar subquery, not as a join.
    """
    means = fleet_means(gold, features).select(F.struct(*features).alias("means")).scalar()
    rows = newest_health(gold, features).withColumn("_fleet", means)
    ranked = F.array_sort(
        F.array(*[
            F.struct(
                (-relative_deviation(F.col(f), F.col("_fleet").getField(f))).alias("order"),
                F.lit(i).alias("position"), F.lit(f).alias("name"),
            )
            for i, f in enumerate(features)
        ])
    )
    names = F.transform(F.slice(ranked, 1, top), lambda r: r["name"])
    return rows.select("vehicle_id", names.alias("top_features"))
