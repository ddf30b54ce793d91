"""Approximate nearest neighbours by collision counting.

An index block holds its vectors' projections on random lines, each line as a
sorted array. A query opens a window around its own projection on every line;
virtual rehashing widens all windows together. A vector found in enough windows
is verified by its true distance. The windows stop widening when enough vectors
are verified, or when none is left.

Equal vectors are searched once: a class of them is represented by its vector
and its smallest ids, as many as a query can need.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.runtime import ship, stored

LINES, THRESHOLD, WIDEN = 128, 0.8, 1.08
#: Share of a block that is verified before its windows stop widening. Sets the recall; measured in the README.
VERIFIED = 0.15
BLOCK_VECTORS = 8_192


class LineIndex:
    """Sorted projections of a block of vectors, all of one dimension."""

    def __init__(self, vectors: np.ndarray, lines: int = LINES):
        self.vectors = vectors
        self.lines = np.random.default_rng(vectors.shape[1]).standard_normal((vectors.shape[1], lines))
        projected = vectors @ self.lines
        self.order = np.ascontiguousarray(np.argsort(projected, axis=0, kind="stable").T)
        self.values = np.sort(projected, axis=0).T.copy()
        spread = self.values[:, -1] - self.values[:, 0]
        self.widest = float(spread.max()) or 1.0
        self.level = 0

    def search(self, query: np.ndarray, k: int, verified: float = VERIFIED) -> tuple[np.ndarray, np.ndarray]:
        """Verified vectors' places and distances, at least k of them or all.

        Windows are centred on the query, so one of a level holds those of every level below. The answer is that of
        the lowest level with enough vectors; the level of the query before is only where the search for it begins.
        """
        n = len(self.vectors)
        need = min(n, k + ceil(verified * n))
        center = query @ self.lines
        widest = 2 * self.widest + np.abs(center).max()

        def enough(level: int) -> np.ndarray | None:
            half = self.widest * WIDEN ** (level - 64)
            found = self._passing(center, half)
            if len(found) >= need:
                return found
            return np.arange(n) if half > widest else None

        level, found = self.level, enough(self.level)
        while found is None:
            level += 1
            found = enough(level)
        while level == self.level and level > 0 and (lower := enough(level - 1)) is not None:
            level, self.level, found = level - 1, level - 1, lower
        self.level = level
        return found, np.sqrt(((self.vectors[found] - query) ** 2).sum(axis=1))

    def _passing(self, center: np.ndarray, half: float) -> np.ndarray:
        """Vectors in enough of the windows."""
        parts = [self.order[j, a:b] for j, (a, b) in enumerate(self._windows(center, half)) if a < b]
        counts = np.bincount(np.concatenate(parts), minlength=len(self.vectors)) if parts else np.zeros(len(self.vectors), np.int64)
        return np.flatnonzero(counts >= ceil(THRESHOLD * len(self.order)))

    def _windows(self, center: np.ndarray, half: float) -> Iterator[tuple[int, int]]:
        for j, c in enumerate(center.tolist()):
            yield self.values[j].searchsorted(c - half), self.values[j].searchsorted(c + half, side="right")


def usable(vector: str):
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, block: int = BLOCK_VECTORS, id_col: str = "vec_id", vector_col: str = "embedding", verified: float = VERIFIED) -> DataFrame:
    """For each id divisible by ``every``: its ``k`` nearest rows found, as query_id, rank, vec_id, score.

    The score is the Euclidean distance in double precision; ties go to the smaller id. Vectors that are null, zero
    or not finite, and null ids, take no part. Vectors of different dimensions are not compared. A query's own id is
    no candidate. Rows of one id with different vectors are several candidates, of which the nearest counts, and
    several queries, answered together. Every row is in the index. Queries meet the index in blocks: each task holds
    one block of at most about ``block`` distinct vectors and reads all queries as a stream.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(usable("vector") & F.col("vec_id").isNotNull())
    # Zero has one sign, so that equal vectors are equal arrays.
    rows = stored(rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).distinct(), "vectors")
    # k ids of a class besides the query's own are the most that an answer can hold.
    smallest = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    classes = rows.withColumn("place", smallest).where(F.col("place") <= k + 1).groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = stored(classes.withColumn("class", F.monotonically_increasing_id()).withColumn("dimension", F.size("vector")), "classes")
    asked = stored(rows.where(F.col("vec_id") % every == 0).withColumnRenamed("vec_id", "query_id").join(classes.select("vector", "class", "dimension"), "vector"), "queries")

    sizes = {r.dimension: max(1, ceil(r.n / block)) for r in classes.groupBy("dimension").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = F.create_map(*[F.lit(v) for pair in sizes.items() for v in pair])[F.col("dimension")] if sizes else F.lit(1)
    data = classes.select("dimension", F.pmod(F.xxhash64("vector"), blocks).cast("int").alias("block"), F.lit(0).alias("query"), "class", "vector", "ids")
    asking = asked.select("dimension", "class", "vector").distinct().select("dimension", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("query"), "class", "vector", F.array().cast("array<long>").alias("ids"))
    met = data.unionByName(asking).repartition(max(1, sum(sizes.values())), "dimension", "block").sortWithinPartitions("dimension", "block", "query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, ids, index = None, [], [], None
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            columns = (batch.column(c).to_pylist() for c in ("dimension", "block", "query", "class", "ids"))
            for dimension, number, query, name, own, vector in zip(*columns, batch.column("vector"), strict=True):
                if (dimension, number) != key:
                    key, held, ids, index = (dimension, number), [], [], None
                values = vector.values.to_numpy(zero_copy_only=False)
                if not query:
                    held.append(values)
                    ids.append(own)
                    continue
                if not held:
                    continue
                if index is None:
                    index = LineIndex(np.stack(held).astype(float))
                places, distances = index.search(values, k + 1, verified)
                # Classes are ranked by distance; of equal ones all that could be wanted go on.
                order = np.argsort(distances, kind="stable")
                cut = distances[order[min(k, len(order) - 1)]]
                near = [(float(distances[p]), i) for p in order[: np.searchsorted(distances[order], cut, side="right")] for i in ids[places[p]]]
                for d, i in sorted(near)[: k + 1]:
                    out[0].append(name)
                    out[1].append(i)
                    out[2].append(d)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())], names=["class", "vec_id", "score"])

    found = met.mapInArrow(run, "class long, vec_id long, score double")
    best = found.withColumn("place", F.row_number().over(Window.partitionBy("class").orderBy("score", "vec_id"))).where(F.col("place") <= k + 1)
    answers = asked.select("query_id", "class").join(best.select("class", "vec_id", "score"), "class").where("query_id != vec_id")
    answers = answers.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
