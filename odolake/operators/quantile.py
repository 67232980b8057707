"""Exact quantile of a column without bringing the column together."""

from __future__ import annotations

from math import floor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_quantile(df: DataFrame, column: str, q: float, bins: int = 1024, enough: int = 50_000) -> float | None:
    """Linear-interpolated quantile, as ``percentile``, for any number of rows.

    Each round counts the values of the current interval in ``bins`` slices (one small
    aggregate) and goes on with the slice that holds the wanted rank, until few distinct
    values are left. Copies of a value are counted, never listed.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    head = values.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    if not head.n:
        return None
    position = (head.n - 1) * q
    rank = floor(position)
    fraction = position - rank

    low, high, below, inside = head.lo, head.hi, 0, head.n
    while inside > enough and low < high:
        width = (high - low) / bins
        if width == 0.0 or low + width == low:
            break
        part = values.where(F.col("v").between(low, high))
        slices = (
            part.groupBy(F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).alias("b"))
            .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            .orderBy("b").collect()  # at most ``bins`` rows
        )
        seen = below
        for i, s in enumerate(slices):
            if rank < seen + s.n:
                if rank == seen + s.n - 1 and fraction > 0.0:
                    # the two neighbouring order statistics lie in different slices
                    return s.hi + (slices[i + 1].lo - s.hi) * fraction
                below, inside, low, high = seen, s.n, s.lo, s.hi
                break
            seen += s.n
    if low == high:
        return low
    counted = (
        values.where(F.col("v").between(low, high)).groupBy("v").agg(F.count("*").alias("n")).orderBy("v").collect()
    )
    return _pick(counted, rank - below, fraction)


def _pick(counted: list, rank: int, fraction: float) -> float:
    seen = 0
    for i, row in enumerate(counted):
        seen += row.n
        if rank < seen:
            if fraction > 0.0 and rank == seen - 1 and i + 1 < len(counted):
                return row.v + (counted[i + 1].v - row.v) * fraction
            return row.v
    raise ValueError("rank outside the counted values")
