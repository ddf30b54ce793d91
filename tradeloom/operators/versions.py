"""Versioned plans and effective-dated (SCD type 2) entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

OPEN_END = "9999-12-31"


def flag_latest(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    identity: Sequence[str],
    flag: str = "is_latest",
) -> DataFrame:
    """Mark the first row of each group, keeping every row.

    The newest identity of a group is an aggregate over narrow columns, combined
    before the shuffle, so a hot group is one row per task. Rows then meet it by
    (group, identity), which is unique and cannot skew; each full row moves once
    at most. A missing value counts as newest. ``identity`` must be unique within
    the group.
    """
    keys = [*order, *identity]
    ranking = F.struct(*[f(c) for c in keys for f in (lambda c: F.col(c).isNull().alias(f"_n_{c}"), lambda c: F.col(c).alias(f"_v_{c}"))])
    first = df.groupBy(*[F.col(g).alias(f"_g_{g}") for g in group]).agg(F.max(ranking).alias("_first"))
    winner = first.select(*[f"_g_{g}" for g in group], *[F.col(f"_first._v_{c}").alias(f"_i_{c}") for c in identity], F.lit(True).alias("_won"))
    same = [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in group] + [F.col(c).eqNullSafe(F.col(f"_i_{c}")) for c in identity]
    return df.join(winner, same, "left").select(*df.columns, F.col("_won").isNotNull().alias(flag))


def scd2(
    df: DataFrame,
    entity: str,
    effective: str,
    end: str | None = None,
) -> DataFrame:
    """Closed validity interval and current flag per entity version.

    A version ends the day before its successor starts; the last one ends on
    ``end`` if known, else on the open end. A version without a start sorts
    last. The input holds one row per (entity, day), so an entity has at most as
    many rows as the calendar has days: the window needs no splitting.
    """
    successor = F.lead(effective).over(
        Window.partitionBy(entity).orderBy(F.col(effective).asc_nulls_last())
    )
    open_end = F.lit(OPEN_END).cast("date")
    last_day = F.col(end) if end else F.lit(None).cast("date")
    return (
        df.withColumn("_next", successor)
        .withColumn("effective_from", F.col(effective))
        .withColumn("effective_to", F.coalesce(F.date_sub("_next", 1), last_day, open_end))
        .withColumn("is_current", F.col("_next").isNull())
        .drop("_next")
    )
