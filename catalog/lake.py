"""The telemetry layers that Spark derives from the given tables, for the catalogue queries."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolake.functions.numeric import round_half_even
from odolake.operators import alerting, cleaning, health, ingest, rate_limit, validation
from odolake.session import configure, spread, staged
from catalog import telemetry

# Time parameters stretched to the density of the events (about two per vehicle and day).
AS_OF = "2024-01-31 00:00:00"
DAY = 86_400
WINDOW = DAY
LOOKBACK = 5 * DAY
UNIT_MINUTES = 1440.0
ONLINE = 2 * DAY
REFILL = 0.25 / 36_000  # a quarter token per ten hours
QUIET_HOURS = 96
PRODUCTION_CUT, SHADOW_CUT = 80.0, 76.0


class Lake:
    """Layers of one data directory; each is a plain DataFrame, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = configure(spark), sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        return telemetry.bronze(self.spark, self.sf_dir)

    @cached_property
    def vehicles(self) -> DataFrame:
        return telemetry.vehicles(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        """Raw events of evenly dealt readings, as building and checking them is costly."""
        return telemetry.raw_events(telemetry.readings(spread(telemetry.table(self.spark, self.sf_dir, "events"), "event_id")))

    @cached_property
    def inspected(self) -> DataFrame:
        return validation.inspect(self.raw)

    @cached_property
    def routed(self) -> DataFrame:
        return self.inspected.withColumn("outcome", ingest.outcome())

    @cached_property
    def limited(self) -> DataFrame:
        """Outcomes with the rate limiter in its place between the entry and the field checks.

        What the limiter and the routing ask of the parsed events is written once, as both read it; payloads and
        fields are of no use to an outcome and are left out.
        """
        events = staged(self.inspected.select("id", "received_at", "limiter_key", "entry_reason", "reason"), "inspected")
        verdicts = rate_limit.token_bucket(events, key="limiter_key", refill_per_second=REFILL)
        refused = verdicts.where(~F.col("allowed"))  # only these travel to their events
        return events.join(refused, "id", "left").withColumn("outcome", ingest.outcome(F.col("allowed")))

    @cached_property
    def dlq(self) -> DataFrame:
        return ingest.dead_letters(self.routed)

    @cached_property
    def assessed(self) -> DataFrame:
        return cleaning.assess(self.bronze, self.vehicles)

    @cached_property
    def silver(self) -> DataFrame:
        return cleaning.cleaned_rows(self.assessed)

    @cached_property
    def gold(self) -> DataFrame:
        return health.gold_sliding(self.silver, WINDOW, LOOKBACK, UNIT_MINUTES)

    @cached_property
    def stored_gold(self) -> DataFrame:
        """Gold as a stored table, for the reports that read it several times."""
        return staged(self.gold, "gold")

    @cached_property
    def predictions(self) -> DataFrame:
        """Stand-in scores SQL can follow: distance of the health score from a cut, per mode."""
        def mode(name: str, cut: float) -> DataFrame:
            score = round_half_even((F.col("health_score") - F.lit(cut)) / F.lit(100.0), 4)
            return self.stored_gold.select(
                "vehicle_id", "window_start", score.alias("anomaly_score"), (score < 0).alias("is_anomaly"),
                F.lit("v1.0").alias("model_version"), F.lit(name).alias("mode"),
                F.col("window_end").alias("predicted_at"),
            )

        return mode("production", PRODUCTION_CUT).unionByName(mode("shadow", SHADOW_CUT))

    @cached_property
    def alerts(self) -> DataFrame:
        return alerting.with_causes(alerting.replay_alerts(self.predictions, 2, QUIET_HOURS, 1.2), self.stored_gold)

    def store_layers(self) -> None:
        """Write every layer once, as a running lake has them; reports then read stored tables."""
        for name in ("bronze", "vehicles", "silver", "stored_gold", "predictions", "alerts", "dlq"):
            self.__dict__[name] = staged(getattr(self, name), name)

    @property
    def tables(self) -> Mapping[str, DataFrame]:
        return _Tables(self)


class _Tables(Mapping):
    """Table name -> layer; a layer is built only when a report asks for it."""

    layers = {
        "bronze_telemetry": "bronze", "vehicle_metadata": "vehicles", "silver_telemetry": "silver",
        "gold_vehicle_health": "stored_gold", "predictions": "predictions", "alerts": "alerts", "bronze_dlq": "dlq",
    }

    def __init__(self, lake: Lake):
        self.lake = lake

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self.lake, self.layers[name])

    def __iter__(self):
        return iter(self.layers)

    def __len__(self) -> int:
        return len(self.layers)


def plain(df: DataFrame) -> DataFrame:
    """Times as text, flags as 0/1 and lists as joined text, so any engine can compare them."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws(",", c)
        out.append(c.alias(f.name))
    return df.select(*out)
