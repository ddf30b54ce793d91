"""Facts in month partitions, sliced through the calendar.

A slice by fiscal year or quarter names no dates. It joins the calendar, and Spark
then reads only the partitions of the months that the calendar's rows are in
(dynamic partition pruning), whatever the calendar's attributes say.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from tradeloom.operators.keys import all_of

MONTH = "month_part"


def store_months(df: DataFrame, date: str, path: str, month: str = MONTH) -> DataFrame:
    """Write rows to a partition for each month of ``date`` and read them back with the column ``month``.

    Months are rebalanced, not hashed: a month too large for one task becomes several files. Rows without a date are a
    partition of their own. Equal rows stay; an empty table stays empty.
    """
    if month in df.columns:
        raise ValueError(f"there is a column {month!r} already")
    parts = df.withColumn(month, F.trunc(df[date], "month")).hint("rebalance", month).sortWithinPartitions(month, date)
    parts.write.partitionBy(month).parquet(path)
    return df.sparkSession.read.schema(StructType([*df.schema.fields]).add(month, DateType())).parquet(path)


def slice_by_calendar(fact: DataFrame, date: str, calendar: DataFrame, bring: Sequence[str] = (), month: str = MONTH, **members) -> DataFrame:
    """Rows of a fact in month partitions whose day has the given calendar members, with the calendar columns ``bring``.

    ``calendar`` has a row for each ``date_day``, so the side that is broadcast has one short row for each day. Rows without a
    date, or outside the calendar, are in no slice. A member given as None is matched by NULL.
    """
    clash = set(bring) & set(fact.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    wanted = all_of([F.col(c).eqNullSafe(F.lit(v)) if v is None else F.col(c) == F.lit(v) for c, v in members.items()]) if members else F.lit(True)
    days = calendar.where(wanted).select(F.col("date_day").alias("__day"), F.trunc("date_day", "month").alias("__month"), *bring)
    return fact.join(F.broadcast(days), (fact[month] == days["__month"]) & (fact[date] == days["__day"])).drop("__day", "__month")
