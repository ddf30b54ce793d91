"""Dimension lookups, interval joins and the full outer join of two aggregates.

No join here forces a broadcast of data that can grow: Spark broadcasts a side
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sort-merges, with adaptive execution splitting hot keys of the fact
side. Only the calendar, whose size is fixed, carries a hint.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import month_start
from tradeloom.operators.keys import all_of, any_of


def lookup(fact: DataFrame, dim: DataFrame, on: str, take: Mapping[str, str], dim_on: str | None = None) -> DataFrame:
    """Left join to a dimension on its natural key, adding ``{new name: dim column}``.

    Only the key and the taken columns of the dimension are moved.
    """
    key = f"_{on}"
    side = dim.select(F.col(dim_on or on).alias(key), *[F.col(c).alias(n) for n, c in take.items()])
    return fact.join(side, fact[on] == side[key], "left").drop(key)


def date_lookup(fact: DataFrame, dim_date: DataFrame, on: str, alias: str) -> DataFrame:
    """Left join to the calendar on a date column, adding its ``date_key``.

    The calendar has a fixed number of days, so it may always be broadcast; each
    role of it (order, expected, actual) reuses one broadcast.
    """
    days = dim_date.select(F.col("date_day").alias("_day"), F.col("date_key").alias(alias))
    return fact.join(F.broadcast(days), fact[on] == days["_day"], "left").drop("_day")


def asof_scd(
    fact: DataFrame,
    dim: DataFrame,
    on: str,
    event_date: str,
    take: Mapping[str, str],
    months_of: tuple[str, str] | None = None,
) -> DataFrame:
    """Left join to the version valid on the event date (both ends inclusive).

    Id equality is the join key and the interval a residual condition, so an
    event meets all versions of its id. Where ids have many versions, name the
    first and last day of a calendar in ``months_of``: intervals are then listed
    once for each month of that calendar they cover and joined on (id, month), so
    an event meets the versions of its month only. Events outside the calendar,
    such as mistyped dates, meet all versions of their id; they do not lengthen
    the lists. The caller chooses; no data is read to build the plan.
    """
    side = dim.select(
        F.col(on).alias("_id"),
        F.col("effective_from").alias("_from"),
        F.col("effective_to").alias("_to"),
        *[F.col(c).alias(n) for n, c in take.items()],
    ).where(F.col("_from") <= F.col("_to"))

    def joined(events: DataFrame, versions: DataFrame, *more: Column) -> DataFrame:
        valid = (events[on] == F.col("_id")) & events[event_date].between(F.col("_from"), F.col("_to"))
        return events.join(versions, all_of([valid, *more]), "left").select(*fact.columns, *take)

    if not months_of:
        return joined(fact, side)
    low, high = (F.lit(d).cast("date") for d in months_of)
    months = F.sequence(month_start(F.greatest("_from", low)), month_start(F.least("_to", high)), F.expr("interval 1 month"))
    listed = side.where((F.col("_from") <= high) & (F.col("_to") >= low)).withColumn("_month", F.explode(months))
    inside = F.coalesce(F.col(event_date).between(low, high), F.lit(False))
    within = joined(fact.where(inside), listed, F.trunc(F.col(event_date), "month") == F.col("_month"))
    return within.unionByName(joined(fact.where(~inside), side))


def asof_merge(fact: DataFrame, dim: DataFrame, on: str, event_date: str, take: Mapping[str, str]) -> DataFrame:
    """Left join to the version valid on the event date, by merging dates with version starts.

    The intervals of an id do not overlap, as ``scd2`` makes them; of versions that
    start on one day the greatest counts. Each (id, date) that occurs in the events
    is merged once with the id's starts in date order and takes the last start
    before it, if that version has not ended. The work is linear in events and
    versions, whatever the dates and however many versions an id has.

    However many events an id has, it comes to the window with its different dates
    alone, combined before the shuffle: at most one row a day and version. The
    events then meet their date's version by (id, date), which is unique on that
    side, so adaptive execution may split a hot id's events further.
    """
    version = F.struct(F.col("effective_to").alias("_to"), *[F.col(c).alias(n) for n, c in take.items()])
    starts = dim.where(F.col("effective_from") <= F.col("effective_to")).select(
        F.col(on).alias("_id"), F.col("effective_from").alias("_at"), F.lit(False).alias("_event"), version.alias("_version")
    )
    kind = starts.schema["_version"].dataType
    dates = fact.select(F.col(on).alias("_id"), F.col(event_date).alias("_at")).where("_id is not null and _at is not null").distinct()
    merged = starts.unionByName(dates.select("_id", "_at", F.lit(True).alias("_event"), F.lit(None).cast(kind).alias("_version")))
    # A start comes before the events of its day.
    until_now = Window.partitionBy("_id").orderBy("_at", "_event", "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = merged.withColumn("_last", F.last("_version", ignorenulls=True).over(until_now))
    valid = last.where(F.col("_event") & (F.col("_at") <= F.col("_last._to"))).select("_id", "_at", *[F.col(f"_last.{n}").alias(n) for n in take])
    same = (fact[on] == valid["_id"]) & (fact[event_date] == valid["_at"])
    return fact.join(valid, same, "left").select(*[fact[c] for c in fact.columns], *[valid[n] for n in take])


def full_outer_coalesce(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], spread: int = 8192, apart: Sequence[str] | None = None
) -> DataFrame:
    """Full outer join on ``{left column: right column}``, keys coalesced.

    Each side is an aggregate with at most one row per key. NULL keys match
    nothing and survive on both sides. As they would all hash to one task, rows
    with a NULL key get a spread value as an additional join key, which is
    constant for all other rows. The value comes from all columns, or on the right
    side from those that tell its rows apart (``apart``): what a reader of the
    result does not need of the others is then not computed.
    """
    def spread_nulls(df: DataFrame, keys: Sequence[str], name: str, of: Sequence[str]) -> DataFrame:
        has_null = any_of([F.col(k).isNull() for k in keys])
        value = F.when(has_null, 1 + F.pmod(F.xxhash64(*of), F.lit(spread))).otherwise(F.lit(0))
        return df.withColumn(name, value)

    a = spread_nulls(left, list(on), "_lspread", left.columns)
    b = spread_nulls(right, list(on.values()), "_rspread", apart or right.columns)
    condition: Column = all_of([a[l] == b[r] for l, r in on.items()]) & (a["_lspread"] == b["_rspread"])
    joined = a.join(b, condition, "full")
    keys = [F.coalesce(a[l], b[r]).alias(l) for l, r in on.items()]
    rest = [a[c] for c in left.columns if c not in on]
    rest += [b[c] for c in right.columns if c not in on.values()]
    return joined.select(*keys, *rest)
