"""Isolation forest (Liu, Ting, Zhou, ICDM 2008) trained and scored as Spark jobs.

The training rows are never gathered: every tree takes a bounded, hash-chosen sample, so
the trees depend on the data and the seed but not on the partitioning. A forest is a
table of nodes bounded by trees x sample size, small enough to broadcast by construction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from odolake import schemas as S
from odolake.functions.timing import instant, seconds
from odolake.operators.quantile import exact_quantile
from odolake.session import staged

NODES = "tree INT, node INT, feature INT, threshold DOUBLE, left INT, right INT, size INT, depth INT"

HEADER = "features ARRAY<STRING>, mean ARRAY<DOUBLE>, scale ARRAY<DOUBLE>, sample_size INT, trained_rows BIGINT, " \
         "offset DOUBLE, version STRING"


@dataclass(frozen=True)
class Forest:
    """A fitted model: scaler, node table and decision threshold."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    sample_size: int
    trained_rows: int
    nodes: pd.DataFrame = field(repr=False)
    offset: float = -0.5
    version: str = S.MODEL_VERSION


def average_path(n: np.ndarray | float) -> np.ndarray | float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3.0)
    big = 2.0 * (np.log(safe - 1.0) + 0.5772156649015329) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, big))


def scaler(rows: DataFrame, features: Sequence[str] = S.FEATURES) -> DataFrame:
    """One row: number of complete rows, then mean and population deviation per feature."""
    complete = F.lit(True)
    for f in features:
        complete = complete & F.col(f).isNotNull()
    aggs = [F.count("*").alias("rows_read"), F.count_if(complete).alias("rows_complete")]
    for f in features:
        value = F.when(complete, F.col(f))
        aggs += [F.avg(value).alias(f"mean_{f}"), F.stddev_pop(value).alias(f"dev_{f}")]
    return rows.agg(*aggs)


def _scaled(features: Sequence[str], mean: Sequence[float], scale: Sequence[float]) -> Column:
    return F.array(*[(F.coalesce(F.col(f), F.lit(0.0)) - F.lit(m)) / F.lit(s) for f, m, s in zip(features, mean, scale)])


def _unit_hash(*cols: Column) -> Column:
    """Deterministic uniform number in [0, 1) from the given columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(2**52)) / F.lit(float(2**52))


def tree_samples(
    points: DataFrame, keys: Sequence[str], n: int, trees: int, sample_size: int, seed: int
) -> DataFrame:
    """(tree, keys, x): for every tree its ``sample_size`` rows, chosen by hash of the key.

    A common draw of about ``1.3 * trees * sample_size`` rows is taken first; each tree
    then draws twice what it needs from it and keeps the rows with the smallest hashes.
    Keys are unique, so no draw can grow with the data.
    """
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    pool_share = min(1.0, 1.3 * trees * sample_size / n)
    tree_share = min(1.0, 2.0 * sample_size / (n * pool_share))
    pool = points.select(key.alias("key"), "x").where(_unit_hash(F.col("key"), F.lit(seed)) < pool_share)
    drawn = pool.select(
        "key", "x",
        F.explode(
            F.filter(
                F.sequence(F.lit(0), F.lit(trees - 1)),
                lambda t: _unit_hash(F.col("key"), F.lit(seed), F.lit("tree"), t) < tree_share,
            )
        ).alias("tree"),
    )
    order = Window.partitionBy("tree").orderBy(F.xxhash64("key", F.lit(seed), F.lit("pick"), "tree"), "key")
    return drawn.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= sample_size).drop("_rn")


def _grower(sample_size: int, seed: int):
    limit = max(1, ceil(log2(max(sample_size, 2))))

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        """Split one tree's sample at random cuts until points are alone or depth is used up."""
        rows = rows.sort_values("key")
        tree = int(rows["tree"].iloc[0])
        x = np.vstack(rows["x"].to_numpy()).astype(float)
        rng = np.random.default_rng([seed, tree])
        nodes: list[list] = []
        pending = [(np.arange(len(x)), 0, -1, "")]
        while pending:
            members, depth, parent, side = pending.pop()
            node = len(nodes)
            if parent >= 0:
                nodes[parent][4 if side == "left" else 5] = node
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= limit or not len(open_features):
                nodes.append([tree, node, -1, 0.0, node, node, len(members), depth])
                continue
            f = int(rng.choice(open_features))
            cut = float(rng.uniform(low[f], high[f]))
            nodes.append([tree, node, f, cut, node, node, len(members), depth])
            goes_left = x[members, f] <= cut
            pending.append((members[~goes_left], depth + 1, node, "right"))
            pending.append((members[goes_left], depth + 1, node, "left"))
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])

    return grow


def _score_udf(spark, forest: Forest):
    """Pandas UDF: scaled feature array -> negated anomaly score, higher is more normal."""
    n = forest.nodes.sort_values(["tree", "node"])
    counts = n.groupby("tree").size().to_numpy()
    base = np.concatenate([[0], np.cumsum(counts)[:-1]])
    shift = np.repeat(base, counts)
    leaf = n["feature"].to_numpy() < 0
    flat = {
        "root": base,
        "feature": np.where(leaf, 0, n["feature"]).astype(np.int64),
        "cut": n["threshold"].to_numpy(),
        "left": n["left"].to_numpy() + shift,
        "right": n["right"].to_numpy() + shift,
        "length": n["depth"].to_numpy() + average_path(n["size"].to_numpy()),
        "levels": int(n["depth"].max()),
        "norm": float(average_path(forest.sample_size)) or 1.0,
    }
    shared = spark.sparkContext.broadcast(flat)

    @F.pandas_udf("double")
    def normality(x: pd.Series) -> pd.Series:
        m = shared.value
        if not len(x):
            return pd.Series([], dtype=float)
        points = np.vstack(x.to_numpy())
        row = np.arange(len(points))[:, None]
        at = np.broadcast_to(m["root"], (len(points), len(m["root"]))).copy()
        for _ in range(m["levels"]):
            at = np.where(points[row, m["feature"][at]] <= m["cut"][at], m["left"][at], m["right"][at])
        return pd.Series(-np.exp2(-m["length"][at].mean(axis=1) / m["norm"]))

    return normality


def fit_forest(
    gold: DataFrame, as_of=None, lookback_days: float | None = 30, features: Sequence[str] = S.FEATURES,
    keys: Sequence[str] = ("vehicle_id", "window_start"), trees: int = 100, sample_size: int = 256,
    seed: int = 42, contamination: float = S.CONTAMINATION, min_rows: int = 10,
    time: str = "aggregated_at", version: str = S.MODEL_VERSION, include_erased: bool = False,
) -> Forest | None:
    """Train on the complete rows of the look-back; None when there are too few of them."""
    spark = gold.sparkSession
    rows = gold
    if lookback_days is not None:
        rows = rows.where(F.col(time) >= instant(as_of) - seconds(lookback_days * 86400.0))
    if not include_erased:
        rows = rows.where(F.col("vehicle_id") != S.ERASED)
    rows = staged(rows.select(*keys, *features).dropDuplicates(list(keys)), "training")
    facts = scaler(rows, features).first()
    if facts.rows_read < min_rows or facts.rows_complete < min_rows:
        return None
    mean = tuple(facts[f"mean_{f}"] for f in features)
    scale = tuple(facts[f"dev_{f}"] or 1.0 for f in features)
    n = facts.rows_complete
    psi = min(sample_size, n)
    points = rows.na.drop(subset=list(features)).select(*keys, _scaled(features, mean, scale).alias("x"))
    samples = tree_samples(points, keys, n, trees, psi, seed)
    # bounded by trees x (2 x sample size - 1) nodes, whatever the number of rows
    nodes = samples.groupBy("tree").applyInPandas(_grower(psi, seed), NODES).toPandas()
    forest = Forest(tuple(features), mean, scale, psi, n, nodes, version=version)
    trained = staged(points.select(_score_udf(spark, forest)("x").alias("score")), "training-scores")
    return replace(forest, offset=exact_quantile(trained, "score", contamination))


def save_forest(spark: SparkSession, forest: Forest, path: str, trained_at) -> None:
    """Append a model to the model tables, keyed by its training time."""
    header = spark.createDataFrame(
        [(list(forest.features), list(forest.mean), list(forest.scale), forest.sample_size, forest.trained_rows,
          forest.offset, forest.version)], HEADER)
    stamp = instant(trained_at).alias("trained_at")
    header.select("*", stamp).write.mode("append").parquet(f"{path}/models")
    spark.createDataFrame(forest.nodes, NODES).select("*", stamp).write.mode("append").parquet(f"{path}/model_nodes")


def load_forest(spark: SparkSession, path: str, as_of=None) -> Forest | None:
    """The model trained last, at ``as_of`` or before."""
    models = spark.read.parquet(f"{path}/models").where(F.col("trained_at") <= instant(as_of))
    h = models.orderBy(F.desc("trained_at")).first()
    if h is None:
        return None
    mine = spark.read.parquet(f"{path}/model_nodes").where(F.col("trained_at") == F.lit(h.trained_at))
    nodes = mine.drop("trained_at").toPandas()  # one forest: trees x (2 x sample size - 1) rows at most
    return Forest(tuple(h.features), tuple(h.mean), tuple(h.scale), h.sample_size, h.trained_rows, nodes, h.offset, h.version)


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """Add ``anomaly_score`` (negative is anomalous, 4 digits) and ``is_anomaly``; null features count as 0."""
    raw = _score_udf(rows.sparkSession, forest)(_scaled(forest.features, forest.mean, forest.scale))
    decision = F.col("_normality") - F.lit(forest.offset)
    return rows.withColumn("_normality", raw).select(
        *rows.columns,
        (F.rint(decision * F.lit(1e4)) / F.lit(1e4)).alias("anomaly_score"),
        (decision < 0).alias("is_anomaly"),
    )


def predictions(latest: DataFrame, forest: Forest, mode: str, predicted_at) -> DataFrame:
    """Rows of the predictions table for the given (newest) health rows.

    ``predicted_at`` is a moment, or a column of the rows.
    """
    scored = score(latest, forest)
    stamp = predicted_at if isinstance(predicted_at, Column) else instant(predicted_at)
    return scored.select(
        "vehicle_id", "window_start", "anomaly_score", "is_anomaly",
        F.lit(forest.version).alias("model_version"), F.lit(mode).alias("mode"),
        stamp.alias("predicted_at"),
    )

