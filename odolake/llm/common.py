"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from odolake.session import configure, shared_dir, staged

__all__ = ["configure", "hidden", "once", "runs", "shared_dir", "sorted_groups", "staged", "table", "text_key"]

WORD_GAP = r"[\x20\x09-\x0D]+"  # what stands between two words
WORD_GAP_CHARS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of a data directory, with the columns asked for."""
    df = configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def hidden(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    while name in df.columns:
        name = f"_{name}"
    return name


def once(value: Column) -> Column:
    """``value``, marked so that the optimizer never copies its computation into a filter or another column."""
    return F.when(F.spark_partition_id() >= 0, value)


def text_key(text: Column) -> Column:
    """64-bit identity of a text; a missing text has one of its own."""
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.lit(1), text))


def sorted_groups(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Rows of one key next to each other in one partition, for ``runs``."""
    dealt = df.repartition(partitions, key) if partitions else df.repartition(key)
    return dealt.sortWithinPartitions(key)


def runs(frames: Iterable[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """The groups of consecutive rows with one key, also across the borders of batches."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        if frame.empty:
            continue
        keys = frame[key].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        edges: Sequence[int] = [0, *cuts.tolist(), len(keys)]
        for a, b in zip(edges, edges[1:]):
            if held and held[-1][key].iat[-1] != keys[a]:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(frame.iloc[a:b])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
