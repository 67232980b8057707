"""Clustering around centroids with a pivot table (LAESA) and exact integer distances.

Vectors become integers. Their distances to a few fixed *pivots* are computed once and stored beside them.
In every round the centroids' distances to the pivots give, by the triangle inequality, a lower bound for
the distance of every vector to every centroid. The centroid with the lowest bound is tried first; a
centroid whose bound exceeds that exact distance cannot win and is passed over, and all others receive
exact distances. So pruning never changes an assignment, ties included.

The table of vectors is written once to the shared folder and read by each round. A round sends the
centroids (a few numbers) to the tasks and takes back one sum per task, centroid and component, combined
before they are shuffled. A cluster with most of the rows is thus no heavier than any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolake.llm.common import staged

COMPONENTS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
PIVOTS = 12
PIVOT_SAMPLE = 1024  # vectors that pivots are chosen from; the choice changes the work, never the result
LARGEST = 1 << 27  # distances of larger components would not fit 64 bits
STEP_ROWS = 8192  # vectors that one step of the arithmetic holds


def quantised(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_col: str = "vec_id",
              vector: str = "embedding") -> DataFrame:
    """``id, v`` of the vectors with so many finite components, none missing: ``floor(scale * x)`` each."""
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * F.lit(float(scale))) >= F.lit(float(LARGEST))))
    whole = (F.size(values) == components) & ~bad
    return vectors.where(whole).select(
        F.col(id_col).alias("id"), F.transform(values, lambda x: F.floor(x * F.lit(float(scale))).cast("int")).alias("v"))


def _order(name: Column) -> Column:
    return F.sha2(F.concat(F.lit("3:"), F.coalesce(name.cast("string"), F.lit(""))).cast("binary"), 256)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` (n x m) to those of ``y`` (k x m)."""
    out = np.empty((len(x), len(y)), np.int64)
    for k in range(len(y)):
        gap = x - y[k]
        out[:, k] = np.einsum("ij,ij->i", gap, gap)
    return out


def chosen_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Vectors of the sample far from each other: each next one is the farthest from all before."""
    if not len(sample):
        return sample
    picked = [0]
    nearest = squared(sample, sample[:1])[:, 0]
    while len(picked) < min(count, len(sample)) and nearest.max() > 0:
        picked.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squared(sample, sample[picked[-1:]])[:, 0])
    return sample[picked]


def bounds(to_pivots: np.ndarray, centroids_to_pivots: np.ndarray) -> np.ndarray:
    """Numbers never above the squared distances (n x k), from distances to the pivots (n x p and k x p)."""
    best = np.zeros((len(to_pivots), len(centroids_to_pivots)))
    for k, row in enumerate(centroids_to_pivots):
        gap = np.abs(to_pivots - row)
        gap -= (to_pivots + row) * 2.0 ** -50  # more than rounding can have added
        np.maximum(best[:, k], gap.max(axis=1), out=best[:, k])
    return best * best * (1 - 1e-12)


def nearest(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroids_to_pivots: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid (the smaller of two as near), its squared distance, and the distances computed."""
    low = bounds(to_pivots, centroids_to_pivots)
    first = low.argmin(axis=1)
    gap = x - centroids[first]
    distance = np.einsum("ij,ij->i", gap, gap)
    tried, number = distance.astype(np.float64) * (1 + 1e-12), first.copy()
    done = len(x)
    for k in range(len(centroids)):
        rows = np.flatnonzero((low[:, k] <= tried) & (first != k))
        gap = x[rows] - centroids[k]
        d = np.einsum("ij,ij->i", gap, gap)
        better = (d < distance[rows]) | ((d == distance[rows]) & (k < number[rows]))
        distance[rows[better]], number[rows[better]] = d[better], k
        done += len(rows)
    return number, distance, done


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def pivot_table(vectors: DataFrame, pivots: np.ndarray, components: int) -> DataFrame:
    """``id, v`` with the distances to the pivots, stored once."""

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), components, np.int64)
            far = np.sqrt(squared(x, pivots).astype(np.float64))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(pivots))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.ListArray.from_arrays(ends, pa.array(far.reshape(-1)))],
                names=["id", "v", "far"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("far", T.ArrayType(T.DoubleType()))])
    return staged(vectors.mapInArrow(measure, schema), "pivot-table")


def _steps(batches: Iterable[pa.RecordBatch], components: int, pivots: int):
    for batch in batches:
        for a in range(0, batch.num_rows, STEP_ROWS):
            part = batch.slice(a, STEP_ROWS)
            yield part, _matrix(part.column("v"), components, np.int64), _matrix(part.column("far"), pivots, np.float64)


def _sums(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sums of their components for every centroid that is nearest to one."""
    far = np.sqrt(squared(centroids, pivots).astype(np.float64))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, np.int64)
        for _, x, to_pivots in _steps(batches, centroids.shape[1], len(pivots)):
            number, _, _ = nearest(x, to_pivots, centroids, far)
            count += np.bincount(number, minlength=len(centroids))
            for k in np.unique(number):
                total[k] += x[number == k].sum(axis=0)
        met = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict({
            "cluster": pa.array(np.repeat(met, centroids.shape[1]).astype(np.int32)),
            "place": pa.array(np.tile(np.arange(centroids.shape[1], dtype=np.int32), len(met))),
            "n": pa.array(np.repeat(count[met], centroids.shape[1])), "total": pa.array(total[met].reshape(-1))})

    parts = table.mapInArrow(add, "cluster INT, place INT, n LONG, total LONG")
    rows = parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # k x components
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(rows):
        out.setdefault(r.cluster, (r.n, []))[1].append(int(r.total))
    return out


def fit(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The centroids after so many rounds; one that no vector is nearest to stays where it is."""
    centroids = centroids.copy()
    for _ in range(rounds):
        for k, (n, total) in _sums(table, centroids, pivots).items():
            centroids[k] = [t // n for t in total]
    return centroids


def assigned(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """``id, cluster, distance, measured``: nearest centroid, squared distance, exact distances per vector in its batch."""
    far = np.sqrt(squared(centroids, pivots).astype(np.float64))
    kind = table.schema["id"]

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x, to_pivots in _steps(batches, centroids.shape[1], len(pivots)):
            number, distance, done = nearest(x, to_pivots, centroids, far)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(number.astype(np.int32)), pa.array(distance),
                 pa.array(np.full(len(x), done / max(1, len(x))))], names=["id", "cluster", "distance", "measured"])

    return table.mapInArrow(assign, T.StructType([kind, T.StructField("cluster", T.IntegerType()), T.StructField(
        "distance", T.LongType()), T.StructField("measured", T.DoubleType())]))


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, components: int = COMPONENTS,
            scale: int = SCALE, pivots: int = PIVOTS, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per kept vector: id, ``cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors with another number of components, a missing or a non-finite one are left out, and so are
    those with a component of 2**27 or more once scaled, whose distances a 64-bit number cannot hold. Centroids start
    as the vectors whose ids have the smallest hashes (a missing id is hashed as no digits; equal hashes
    go by their components), so fewer vectors than ``clusters`` make fewer clusters, and repeated rows
    may make equal ones: the smaller number then takes all. An empty table gives an empty result. Columns
    besides id and vector have no influence.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    rows = staged(quantised(vectors, components, scale, id_col, vector), "vectors")
    # a bounded number of rows: the starts and the sample that pivots are chosen from
    head = rows.withColumn("order", _order(F.col("id"))).orderBy("order", "v").limit(max(clusters, PIVOT_SAMPLE)).collect()
    if not head:
        return spark.createDataFrame(
            [], f"{id_col} {kind}, cluster INT, distance LONG, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING")
    sample = np.array([r.v for r in head], np.int64)
    fixed = chosen_pivots(sample, pivots)
    table = pivot_table(rows, fixed, components)
    centroids = fit(table, sample[:clusters], fixed, rounds)
    found = staged(assigned(table, centroids, fixed).select("id", "cluster", "distance"), "assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # a row per cluster
    per = {r.cluster: int(r.s) for r in sums}
    about = [(k, s, sum(per.values()), hashlib.sha256(",".join(map(str, centroids[k].tolist())).encode()).hexdigest())
             for k, s in per.items()]
    about = spark.createDataFrame(about, "cluster INT, cluster_inertia LONG, inertia LONG, centroid_sha256 STRING")
    out = found.join(F.broadcast(about), "cluster")  # a row per cluster
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
