"""Centroid clustering with an incremental matrix of exact integer dot products.

Each vector's dot products with all centroids are stored with it. When the
centroids move, a product changes by the vector's components times the changes
of the centroid's; only the components that changed are read for it. The squared
distance then follows from the product and two norms, all exact integers.

Sums of the clusters are kept in the same way: a vector that changes its cluster
is taken from one and added to the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.integers import EXACT, SUMS, finite, floored, lists, matrix, products, summed, sums_batch
from tradeloom.llm.runtime import Rewritten, ship, stored

SCHEMA = "vec_id long, x array<long>, norm long, dots array<long>, before int, cluster int, distance long"
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def moved_products(dots: np.ndarray, vectors: np.ndarray, change: np.ndarray) -> np.ndarray:
    """The products after each centroid (a row) changed by its row of ``change``: only components that changed are read."""
    columns = vectors.T
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(change).max(initial=0)) * max(1, change.shape[1])
    kind = np.float64 if most < EXACT else np.int64
    columns = np.ascontiguousarray(columns, dtype=kind)
    out = dots.copy()
    for j in np.flatnonzero(change.any(axis=1)).tolist():
        at = np.flatnonzero(change[j])
        out[:, j] += (change[j, at].astype(kind) @ columns[at]).astype(np.int64)
    return out


def _assigned(batch: pa.RecordBatch, x: np.ndarray, dots: np.ndarray, norms: np.ndarray, before: np.ndarray) -> pa.RecordBatch:
    """Rows with their nearest centroid; the first of equally near ones."""
    own = batch.column("norm").to_numpy()
    far = norms[None, :] - 2 * dots
    cluster = far.argmin(axis=1)
    distance = own + far[np.arange(len(own)), cluster]
    columns = [batch.column("vec_id"), batch.column("x"), batch.column("norm"), lists(dots), pa.array(before.astype(np.int32)), pa.array(cluster.astype(np.int32)), pa.array(distance)]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])


def first_state(rows: DataFrame, centers: np.ndarray) -> DataFrame:
    """Every product, and each vector's nearest centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (centers**2).sum(axis=1)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"), centers.shape[1])
                yield _assigned(batch, x, products(x, centers.T), norms, np.full(len(x), -1))

    return rows.mapInArrow(run, SCHEMA)


def next_state(state: DataFrame, centers: np.ndarray, change: np.ndarray) -> DataFrame:
    """Products brought up to date for centroids that changed by ``change`` to ``centers``, and the clusters that follow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norms = (centers**2).sum(axis=1)
        for batch in batches:
            if batch.num_rows:
                x, dots = matrix(batch.column("x"), centers.shape[1]), matrix(batch.column("dots"), len(centers))
                yield _assigned(batch, x, moved_products(dots, x, change), norms, batch.column("cluster").to_numpy())

    return state.mapInArrow(run, SCHEMA)


def changed_sums(state: DataFrame, k: int, dimension: int) -> dict[int, tuple[int, list[int]]]:
    """By how much each cluster's count and sums changed: of the vectors that moved alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(k, np.int64), np.zeros((k, dimension), np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), dimension)
            for column, sign in (("cluster", 1), ("before", -1)):
                group = batch.column(column).to_numpy()
                for g in np.unique(group[group >= 0]).tolist():
                    own = x[group == g]
                    counts[g] += sign * len(own)
                    totals[g] += sign * own.sum(axis=0)
        some = np.flatnonzero(counts.astype(bool) | totals.any(axis=1))
        yield sums_batch(some, counts[some], totals[some])

    return summed(state.where("cluster != before").select("x", "before", "cluster").mapInArrow(run, SUMS))


def cluster(
    vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, dimension: int = 64, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors with another number of components, or that are null or hold a null or non-finite one, take no part. A
    component x becomes floor(scale * x). The first centroids are the k vectors whose ``seed`` and id have the least
    SHA-256; of one id's vectors the one with the least components first. Null ids seed nothing, but are assigned. Each
    round assigns every vector to the nearest centroid by squared distance, the smaller number of equally near ones,
    and moves each centroid to the floor of its vectors' mean; an empty one stays, such as the later of two equal
    seeds. Repeated rows are so many vectors. With fewer than k vectors there are so many centroids, and an empty table
    gives no rows. Components so large that a distance might not fit a long are an error. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(finite("vector") & (F.size("vector") == dimension)).select("vec_id", floored("vector", scale, dimension).alias("x"))
    rows = stored(rows.withColumn("norm", F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v * v)), "integers")
    by_hash = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    seeds = rows.where("vec_id is not null").select("x", "vec_id", by_hash.alias("h")).orderBy("h", "vec_id", "x").limit(k).collect()
    if not seeds:
        return spark.createDataFrame([], RESULT)
    centers = np.array([s.x for s in seeds], np.int64).reshape(len(seeds), dimension)
    steps = Rewritten("products")
    state = steps.write(first_state(rows, centers))
    counts, sums = [0] * len(centers), [[0] * dimension for _ in seeds]
    for _ in range(rounds):
        for g, (n, totals) in changed_sums(state, len(centers), dimension).items():
            counts[g] += n
            sums[g] = [a + b for a, b in zip(sums[g], totals, strict=True)]
        means = np.array([[s // n for s in sums[g]] if n else centers[g].tolist() for g, n in enumerate(counts)], np.int64).reshape(centers.shape)
        change = means - centers
        if not change.any():
            break  # nothing can change any more
        centers = means
        state = steps.write(next_state(state, centers, change))
    return _with_totals(state.select("vec_id", "cluster", "distance"), centers)


def _with_totals(state: DataFrame, centers: np.ndarray) -> DataFrame:
    """The sums of the distances, by cluster and over all, and the centroids' digests: one row a cluster, so always broadcast."""
    per = state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia")).collect()
    inertia = sum(r.cluster_inertia for r in per)
    rows = [(r.cluster, r.cluster_inertia, inertia, hashlib.sha256(",".join(map(str, centers[r.cluster].tolist())).encode()).hexdigest()) for r in per]
    totals = state.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(totals), "cluster").select(*[f.split()[0] for f in RESULT.split(", ")])
