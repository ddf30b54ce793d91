"""Contiguous surrogate keys over the distinct members of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.session import ensure_checkpoint_dir


def surrogate(df: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Number the rows 1..n by ``order``, which must be unique.

    Rows are range partitioned, numbered within each partition and shifted by the
    size of the partitions before it, so no task sees all members. The checkpoint
    fixes which partition holds which member for both passes over them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).checkpoint()
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_n", within)
        .join(F.broadcast(shift), "_part")  # one row per partition
        .select((F.col("_n") + F.col("_shift")).cast("long").alias(key), *df.columns)
    )


def dense_surrogate(df: DataFrame, column: str, key: str) -> DataFrame:
    """Number the distinct values of one column 1..n and give each row its value's number."""
    numbered = surrogate(df.select(column).distinct(), [column], key)
    return df.join(numbered, column, "left").select(key, *df.columns)
