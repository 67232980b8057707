"""Newest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from odolake.session import staged


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """All rows that carry the newest ``order`` of their key; ties stay.

    The heads come from a hash aggregate over two columns, combined before the shuffle.
    They are staged, so Catalyst knows their true size: small heads are broadcast and the
    facts do not move; large ones shuffle both sides on (key, order), which spreads a hot
    key over its order values.
    """
    heads = staged(
        df.where(F.col(order).isNotNull()).groupBy(key).agg(F.max(order).alias(order)), "heads"
    )
    return df.join(heads, [key, order], "left_semi").select(*df.columns)


def newest_row(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key, the newest by ``order`` (later names break ties), pre-aggregated."""
    rank = F.struct(*order)
    value = F.struct(*columns)
    return df.groupBy(key).agg(F.max_by(value, rank).alias("_row")).select(key, "_row.*")


def top_n_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key. Spark cuts each task to ``n`` per key before it shuffles."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def merged_latest(stored: DataFrame, batch: DataFrame, key: str, order: str) -> DataFrame:
    """The newest rows of every key, from those of all rows so far and a batch of further ones; ties stay.

    Rows that are stored already are not stored twice, so a batch may come again.
    """
    return latest_per_key(stored.unionByName(batch.select(*stored.columns)), key, order).distinct()
