"""One batch run over a store: clean, aggregate, score, alert; and the replay of a history."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.timing import MICROS, instant
from odolake.operators import alerting, cleaning, drift, forest, health
from odolake.operators.latest import latest_per_key
from odolake.session import pinned, staged
from odolake.sources.store import Store, with_batch_ids
from odolake.sources.versions import Versions


HORIZON_DAYS = 30  # how far back scoring, training and alerting look


def _horizon(as_of) -> datetime:
    return as_of - timedelta(days=HORIZON_DAYS)


def clean_batch(store: Store, batch_id: int, as_of, rows: int | None = None,
                threshold: float = S.BREAKER_THRESHOLD) -> dict:
    """Clean the new raw rows (the next ``rows`` if given), unless too many of them fail. Returns the summary.

    Progress covers rejected rows too, so they are read once; a tripped breaker writes
    nothing and leaves progress where it was. It is stored as a row of its own; only a store that has
    none yet is searched for the highest id that was cleaned.
    """
    marks = Versions(store.spark, f"{store.root}/_progress/clean", "watermark BIGINT")
    known = marks.before(batch_id).first()
    if known is None:
        done = store.read("silver_telemetry").select("bronze_id").unionByName(
            store.read("silver_rejects").select("bronze_id"))
        known = cleaning.progress(done).first()
    watermark = known.watermark
    batch = cleaning.next_batch(store.read("bronze_telemetry"), watermark, rows).where(F.col("vehicle_id") != S.ERASED)
    assessed = pinned(cleaning.assess(batch, store.read("vehicle_metadata")))
    totals = assessed.agg(*cleaning.failure_summary(threshold), F.max("id").alias("last")).first()
    summary = {k: totals[k] for k in ("records_read", "records_written", "records_failed", "circuit_open")}
    summary["watermark"] = watermark
    if totals.records_read and not totals.circuit_open:
        store.write_batch("silver_telemetry", cleaning.cleaned_rows(assessed, instant(as_of)), batch_id)
        store.write_batch("silver_rejects", cleaning.rejected_rows(assessed, instant(as_of)), batch_id)
        summary["watermark"] = totals["last"]
    marks.write(batch_id, store.spark.createDataFrame([(summary["watermark"],)], marks.schema))
    return summary


def aggregate_batch(store: Store, batch_id: int, as_of: datetime, window_seconds: float = 30,
                    lookback_seconds: float = 300, unit_minutes: float = 1.0, cleaned=None) -> DataFrame:
    """Append the health snapshot at ``as_of``, and the earlier windows that the rows of the ``cleaned`` batches fall into.

    The latter keep a backlog from being lost to Gold. A window that Gold has already is aggregated anew within its
    bounds if a late row lies in its look-back, and ``Store.current`` gives its newest row; a late row in no window
    opens what is free of its window of the time grid. So the current rows count no late reading twice. By default the
    rows are this batch's. Only the batches named and the dates from the oldest of their rows on are read.
    """
    window = timedelta(seconds=window_seconds)
    start = as_of - timedelta(seconds=max(lookback_seconds, window_seconds))
    recent = store.read("silver_telemetry", since=start)
    gold = pinned(health.gold_snapshot(recent, as_of, window_seconds, lookback_seconds, unit_minutes))
    batches = [batch_id] if cleaned is None else cleaned
    late = store.read("silver_telemetry", batches=batches).where(
        (F.col("event_timestamp") < instant(as_of - window)) & (F.col("vehicle_id") != S.ERASED))
    oldest = late.agg(F.unix_micros(F.min("event_timestamp")).alias("t")).first().t
    if oldest is not None:
        begin = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=oldest)
        rows = store.read("silver_telemetry", since=begin - timedelta(seconds=lookback_seconds + window_seconds))
        bounds = ["vehicle_id", "window_start", "window_end"]
        known = store.read("gold_vehicle_health", since=begin - 2 * window).select(*bounds).unionByName(gold.select(*bounds))
        slide = int(window_seconds)
        fresh = gold.select("vehicle_id", F.unix_micros("window_start").alias("s"))  # have all readings already
        hit = health.windows_hit(late, known, slide, lookback_seconds).join(fresh, ["vehicle_id", "s"], "left_anti")
        hit = staged(hit, "windows-hit")
        # whole windows of the grid share their panes, so a backlog copies no reading
        whole = (F.col("s") % (slide * MICROS) == 0) & (F.col("e") - F.col("s") == slide * MICROS)
        slid = health.gold_sliding(rows, slide, int(lookback_seconds), unit_minutes)
        on_grid = hit.where(whole).select("vehicle_id", F.timestamp_micros("s").alias("window_start"))
        odd = health.gold_windows(rows, hit.where(~whole), slide, lookback_seconds, unit_minutes)
        gold = gold.unionByName(
            slid.join(on_grid, ["vehicle_id", "window_start"], "left_semi").select(*gold.columns)).unionByName(odd)
    gold = pinned(gold)
    store.write_batch("gold_vehicle_health", gold, batch_id)
    return gold


def score_batch(store: Store, batch_id: int, as_of, live: forest.Forest,
                candidate: forest.Forest | None = None) -> DataFrame:
    """Score the newest health row of every vehicle, with the candidate in shadow mode if given."""
    gold = store.current("gold_vehicle_health", since=_horizon(as_of))
    newest = latest_per_key(gold, "vehicle_id", "aggregated_at")
    rows = forest.predictions(newest, live, "production", as_of)
    if candidate is not None:
        rows = rows.unionByName(forest.predictions(newest, candidate, "shadow", as_of))
    rows = pinned(rows)
    store.write_batch("predictions", rows, batch_id)
    return rows


def alert_batch(store: Store, batch_id: int, as_of, **rules) -> DataFrame:
    """Append the alerts due at ``as_of``."""
    since = _horizon(as_of)
    new = alerting.raise_alerts(
        store.read("predictions", since=since), store.read("alerts", since=since),
        store.current("gold_vehicle_health", since=since), as_of, **rules)
    numbered = pinned(with_batch_ids(new, batch_id))
    store.write_batch("alerts", numbered, batch_id)
    return numbered


def stored_model(store: Store, name: str, as_of, refit: bool, seed: int, **model) -> forest.Forest | None:
    """The newest stored model; trained and stored if there is none yet, or if a refit is asked for."""
    path = f"{store.root}/_models/{name}"
    found = None if refit or not store._exists("_models", name, "models") else forest.load_forest(store.spark, path, as_of)
    if found is None:
        history = store.current("gold_vehicle_health", since=_horizon(as_of))
        found = forest.fit_forest(history, as_of, seed=seed, **model)
        if found is not None:
            forest.save_forest(store.spark, found, path, as_of)
    return found


def drifted(store: Store, as_of, threshold: float, least_rows: int = 100) -> bool:
    """Whether the newest day's production scores lie too far from those of the days before it."""
    scores = store.read("predictions", since=_horizon(as_of)).where(F.col("mode") == "production")
    today = F.to_timestamp(F.to_date(instant(as_of)))
    distances = drift.daily_distance(scores, "anomaly_score", "predicted_at", today, -0.5, 0.05, 20)
    return drift.retrain_due(distances, threshold, least_rows)


def run_cycle(store: Store, batch_id: int, as_of, seed: int = 42, shadow_seed: int = 99, rows: int | None = None,
              gold: dict | None = None, model: dict | None = None, alert: dict | None = None, refit: bool = False,
              drift_threshold: float | None = None) -> dict:
    """One evaluation cycle. A tripped breaker skips the stages after it.

    Models are trained once and then read from the store; ``refit`` trains them anew, and so does a cycle whose
    scores have drifted beyond ``drift_threshold``, if one is given. A stage
    that fails is named in ``errors`` and does not stop those after it, which work on what is stored.
    """
    summary: dict = {"errors": {}}

    def stage(name: str, work):
        try:
            return work()
        except Exception as error:  # noqa: BLE001 - the other stages go on
            summary["errors"][name] = f"{type(error).__name__}: {str(error)[:500]}"
            return None

    summary |= stage("clean", lambda: clean_batch(store, batch_id, as_of, rows)) or {"circuit_open": False}
    if summary["circuit_open"]:
        return summary
    stage("aggregate", lambda: aggregate_batch(store, batch_id, as_of, **(gold or {})))
    if drift_threshold is not None:
        refit = refit or bool(stage("drift", lambda: drifted(store, as_of, drift_threshold)))
        summary["refit"] = refit
    live = stage("train", lambda: stored_model(store, "production", as_of, refit, seed, **(model or {})))
    if live is None:
        return summary
    candidate = stage("train", lambda: stored_model(store, "shadow", as_of, refit, shadow_seed, **(model or {})))
    scored = stage("score", lambda: score_batch(store, batch_id, as_of, live, candidate))
    raised = stage("alert", lambda: alert_batch(store, batch_id, as_of, **(alert or {})))
    if scored is not None:
        summary["predictions_written"] = scored.count()
        summary["anomalies_detected"] = scored.where("is_anomaly AND mode = 'production'").count()
    if raised is not None:
        summary["alerts_raised"] = raised.count()
    return summary


def replay(bronze: DataFrame, vehicles: DataFrame, **shape) -> tuple[DataFrame, DataFrame]:
    """Cleaned layer and health windows of a whole raw history, through the same functions."""
    silver = cleaning.silver(bronze, vehicles)
    return silver, health.gold_sliding(silver, **shape)
