"""Connected components of a graph that is kept in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from odolake.llm.common import staged


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """``node, root`` for every node of ``edges(u, v)`` (longs); the root is the smallest node.

    Alternates large and small stars: every node hooks its neighbours to the smallest one,
    until the graph is a set of stars. Each round is written to the shared folder. Minima
    are combined before the shuffle, so a node with very many neighbours does no harm.
    Raises if ``rounds`` do not suffice, as a node could then have several roots.
    """
    now = edges.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct()
    now = staged(now, "edges")
    seen = None
    for _ in range(rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(
            F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        out = small.where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = staged(out.unionByName(low.select("hi", F.col("m").alias("lo"))).distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % (1 << 31))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    roots = now.select(F.col("lo").alias("node")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root")))
