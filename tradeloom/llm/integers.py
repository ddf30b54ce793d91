"""Vectors as exact integers: which take part, their scaled components, and sums over groups of them."""

from __future__ import annotations

from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Above this, a sum of products is no longer exact in doubles.
EXACT = 1 << 53


def finite(vector: str) -> Column:
    """Whether a vector is there and holds finite components alone."""
    each = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(each, F.lit(False))


def floored(vector: str, scale: int, dimension: int) -> Column:
    """floor(scale * x) of each component; an error where a squared distance might not fit a long."""
    most = isqrt((2**63 - 1) // (4 * max(1, dimension))) - 1
    scaled = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))
    inside = F.forall(vector, lambda x: F.abs(x * F.lit(float(scale))) <= F.lit(float(most)))
    return F.when(inside, scaled).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {most}: squared distances would not fit a long")))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of equal length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def lists(rows: np.ndarray) -> pa.Array:
    """Rows as lists of equal length."""
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(rows).ravel()))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """``left @ right`` of integers, exactly: in doubles where these hold every sum, else in integers."""
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * left.shape[1]
    if most < EXACT:
        return (left.astype(np.float64) @ right.astype(np.float64)).astype(np.int64)
    return left @ right


def summed(partial: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Counts and componentwise sums for each group, of partial rows (group, n, sums).

    What comes back is one row for each group and component: bounded by the model, whatever the rows.
    """
    exact = "decimal(38,0)"
    flat = partial.select("group", F.posexplode(F.concat(F.array("n"), F.col("sums"))).alias("place", "value"))
    rows = flat.groupBy("group", "place").agg(F.sum(F.col("value").cast(exact)).alias("total")).collect()
    found: dict[int, dict[int, int]] = {}
    for r in rows:
        found.setdefault(r.group, {})[r.place] = int(r.total)
    return {g: (by[0], [by[k] for k in range(1, len(by))]) for g, by in found.items()}


SUMS = "group int, n long, sums array<long>"


def sums_batch(groups: np.ndarray, counts: np.ndarray, totals: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(groups.astype(np.int32)), pa.array(counts.astype(np.int64)), lists(totals.astype(np.int64))], names=["group", "n", "sums"])
