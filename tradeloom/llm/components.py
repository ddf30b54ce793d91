"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.runtime import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node goes to the least of the node and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("m"))
    return both.join(least, both.u == least.node).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below go to the least of them. Edges come as (larger u, smaller v)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), "m")
    joined = edges.join(least, edges.u == least.node)
    moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each end of an edge (u, v); the component is its smallest node.

    Loops and repeated edges do not matter. Each turn's edges are written to the shared folder, so that no plan
    grows with the turns. Ends when a turn changes nothing; the turns grow with the logarithm of the nodes.
    """
    edges = stored(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        edges = stored(_small_star(_large_star(edges)), "edges")
    # Each edge is now (node, least node of its component).
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
