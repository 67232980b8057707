"""How far a day's scores lie from those a model was trained on, and when that calls for a new model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(rows: DataFrame, column: str, low: float, width: float, bins: int, *by: Column) -> DataFrame:
    """``bin, rows`` per group; values beyond the ends count in the outer bins."""
    slot = F.floor((F.col(column) - F.lit(low)) / F.lit(width))
    slot = F.greatest(F.lit(0), F.least(F.lit(bins - 1), slot)).cast("int")
    return rows.where(F.col(column).isNotNull()).groupBy(*by, slot.alias("bin")).agg(F.count("*").alias("rows"))


def daily_distance(rows: DataFrame, column: str, time: str, trained_until: Column, low: float, width: float, bins: int) -> DataFrame:
    """``day, rows, distance`` for every day from ``trained_until`` on.

    The distance is half the sum of the differences between the shares of the bins: 0 for equal
    distributions, 1 for disjoint ones. All days are counted in one pass; the rest handles a row per day and bin.
    """
    day = F.to_date(time)
    counts = histogram(rows, column, low, width, bins, day.alias("day"))
    before = counts.where(F.col("day") < F.to_date(trained_until)).groupBy("bin").agg(F.sum("rows").alias("rows"))
    shares = before.agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))), F.sum("rows")).first()  # bins at most
    known, total = dict(shares[0] or {}), shares[1] or 0
    if not total:
        return counts.select("day", F.col("rows"), F.lit(0.0).alias("distance")).where(F.lit(False))
    per_bin = F.element_at(F.create_map(*[x for k in range(bins) for x in (F.lit(k), F.lit(known.get(k, 0) / total))]), F.col("bin"))
    days = counts.where(F.col("day") >= F.to_date(trained_until)).withColumn("share", per_bin)
    per_day = days.groupBy("day").agg(
        F.sum("rows").alias("rows"), F.collect_list(F.struct("rows", "share")).alias("seen"), F.sum("share").alias("covered"))
    gaps = F.aggregate(F.transform("seen", lambda s: F.abs(s["rows"] / F.col("rows") - s["share"])), F.lit(0.0), lambda a, x: a + x)
    return per_day.select("day", "rows", ((gaps + F.lit(1.0) - F.col("covered")) / 2).alias("distance"))


def retrain_due(distances: DataFrame, threshold: float, least_rows: int = 1) -> bool:
    """Whether the newest day with enough rows lies beyond the threshold."""
    newest = distances.where(F.col("rows") >= least_rows).orderBy(F.desc("day")).select("distance").first()
    return newest is not None and newest.distance > threshold
