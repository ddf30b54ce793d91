"""Grouped aggregates, distinct members, shares and rankings."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.functions import month_start, safe_ratio

UNKNOWN = "Unknown"


def distinct_members(df: DataFrame, columns: Sequence[str], unknown: str = UNKNOWN) -> DataFrame:
    """Distinct values, with a named member in place of NULL."""
    return df.select(*[F.coalesce(F.col(c), F.lit(unknown)).alias(c) for c in columns]).distinct()


def target_version_summary(targets_raw: DataFrame) -> DataFrame:
    """Size, coverage and load times of each plan version."""
    return (
        targets_raw.groupBy("version_label")
        .agg(
            F.min("_source_file").alias("source_file"),
            F.min("sheet_name").alias("sheet_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("employee_id").alias("employee_count"),
            F.count_distinct("month_col").alias("month_count"),
            # Text order: T9 comes after T12.
            F.min("month_col").alias("min_month_col"),
            F.max("month_col").alias("max_month_col"),
            F.min("_ingested_at").alias("first_ingested_at"),
            F.max("_ingested_at").alias("last_ingested_at"),
        )
        .orderBy("version_label")
    )


def totals_with_distinct(
    df: DataFrame, by: Mapping[str, Column], counted: tuple[str, str], also: tuple[str, str],
    sums: Mapping[str, str], counts: Mapping[str, Column],
) -> DataFrame:
    """Sums and counts per group, beside exact distinct counts of two columns, from one scan.

    ``counted`` and ``also`` are (column, new name). Spark expands each row once for
    either column and once for the sums, within the scan's stage; what is shuffled
    is combined before: the distinct pairs of (group, value), and one row of sums
    for each group and task. A busy group's pairs spread over many tasks.
    """
    named = df.select(
        *[c.alias(n) for n, c in by.items()], F.col(counted[0]).alias("_counted"), F.col(also[0]).alias("_also"),
        *[F.col(c).alias(f"_{n}") for n, c in sums.items()], *[c.alias(f"_{n}") for n, c in counts.items()],
    )
    return named.groupBy(*by).agg(
        F.count_distinct("_counted").alias(counted[1]), F.count_distinct("_also").alias(also[1]),
        *[F.sum(f"_{n}").alias(n) for n in sums], *[F.count_if(f"_{n}").alias(n) for n in counts],
    )


def totals_in_groups(df: DataFrame, by: Mapping[str, Column], *what) -> DataFrame:
    """The same rows as ``totals_with_distinct``, for lines that come straight from their model, in no order.

    Lines of a group are then scattered, so that neither sums nor pairs combine before a shuffle. They are brought
    together once instead, in the columns needed, and everything follows within the group's task, where its lines are
    sorted, on disk if need be.
    """
    return totals_in_buckets(df, by, *what, together=True)


def totals_in_buckets(
    df: DataFrame, by: Mapping[str, Column], counted: tuple[str, str], also: tuple[str, str],
    sums: Mapping[str, str], counts: Mapping[str, Column], together: bool = False,
) -> DataFrame:
    """The same rows as ``totals_with_distinct``, for a table bucketed by the first column that is counted.

    All rows of such a value are in one bucket, so rows are combined by (group, value, other value) in the scan's stage,
    and the first row of each (group, value) stands for the value: its distinct count is a sum from there on. Values such
    as order ids, of which there are nearly as many as rows, are never shuffled; only the pairs with the other column
    are. On a table without these buckets the result is the same, after an exchange of the combined rows.
    """
    named = df.select(
        *[c.alias(n) for n, c in by.items()], F.col(counted[0]).alias("_counted"), F.col(also[0]).alias("_also"),
        *[F.col(c).alias(f"_{n}") for n, c in sums.items()], *[c.alias(f"_{n}") for n, c in counts.items()],
    )
    if together:
        named = named.repartition(*by)
    combined = named.groupBy(*by, "_counted", "_also").agg(
        *[F.sum(f"_{n}").alias(n) for n in sums], *[F.count_if(f"_{n}").alias(n) for n in counts],
    )
    first = F.row_number().over(Window.partitionBy(*by, "_counted").orderBy("_also")) == 1
    marked = combined.withColumn("_new", (first & F.col("_counted").isNotNull()).cast("long"))
    return marked.groupBy(*by).agg(
        F.sum("_new").alias(counted[1]), F.count_distinct("_also").alias(also[1]),
        # A sum of sums has more digits than the sum of the rows needs.
        *[F.sum(n).cast(combined.schema[n].dataType).alias(n) for n in (*sums, *counts)],
    )


def _totals(by_order: bool, by_group: bool) -> Callable[..., DataFrame]:
    return totals_in_buckets if by_order else totals_in_groups if by_group else totals_with_distinct


def employee_month_actuals(fact_sales: DataFrame, by_order: bool = False, by_group: bool = False) -> DataFrame:
    """Orders, customers and amounts per employee and month; ``by_order`` if the fact is bucketed by order, ``by_group`` if
    its lines come in no order.

    Year and month follow from the month's first day and need not be shuffled.
    """
    totals = _totals(by_order, by_group)(
        fact_sales,
        {"employee_id": F.col("employee_id"), "sales_month_date": month_start("order_date")},
        ("order_id", "total_orders"), ("customer_id", "active_customers"),
        {
            "actual_quantity": "quantity", "actual_gross_amount": "gross_amount", "actual_discount_amount": "discount_amount",
            "actual_revenue": "net_amount", "actual_total_cost": "total_cost", "actual_gross_profit": "gross_profit",
        },
        {},
    )
    return totals.withColumn("sales_year", F.year("sales_month_date")).withColumn("sales_month", F.month("sales_month_date"))


def distributor_month(
    fact_orders: DataFrame, dim_distributors: DataFrame, by_order: bool = False, by_group: bool = False
) -> DataFrame:
    """Order, quantity and delivery totals per distributor, month, region and channel; ``by_order`` and ``by_group`` as above.

    The distributor's attributes depend on its id alone, so they are joined to
    the finished aggregate instead of being carried through the shuffle.
    """
    on_time = F.col("calculated_on_time_delivery")
    totals = _totals(by_order, by_group)(
        fact_orders,
        {
            "distributor_id": F.col("distributor_id"), "month_date": month_start("order_date"),
            "order_region": F.col("region"), "order_channel": F.col("channel"),
        },
        ("order_id", "total_orders"), ("product_id", "products_ordered"),
        {
            "total_qty_ordered": "qty_ordered", "total_qty_delivered": "qty_delivered",
            "total_gross_amount": "gross_amount", "total_delivered_amount": "delivered_amount",
        },
        {
            "on_time_delivery_count": on_time, "late_delivery_count": ~on_time,
            "delivery_record_count": F.col("delivery_status").isNotNull(), "order_record_count": F.lit(True),
        },
    )
    attributes = dim_distributors.select(
        F.col("distributor_id").alias("_id"),
        "distributor_name",
        "tier",
        F.col("channel").alias("distributor_channel"),
        "province",
        F.col("region").alias("distributor_region"),
    )
    return (
        totals.join(attributes, totals["distributor_id"] == attributes["_id"], "left")
        .drop("_id")
        .withColumn("year", F.year("month_date"))
        .withColumn("month", F.month("month_date"))
    )


def monthly_rollup(mart: DataFrame, num: str, den: str, ratio: str) -> DataFrame:
    """Two mart measures and their ratio of sums per month."""
    return (
        mart.groupBy("year", "month")
        .agg(F.sum(num).alias(num), F.sum(den).alias(den))
        .withColumn(ratio, safe_ratio(num, den))
        .orderBy("year", "month")
    )


def share_of_total(df: DataFrame, measure: str, share: str) -> DataFrame:
    """Each row's part of the measure's total, as a percentage.

    The total is a scalar subquery, so no window gathers all rows in one task.
    """
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(share, safe_ratio(F.col(measure), total, scale=4))


def latest(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """Newest ``n`` rows."""
    return df.orderBy(*[F.col(c).desc_nulls_first() for c in order]).limit(n)


def top_n(df: DataFrame, measure: Column | str, tie: str, n: int, top: bool = True) -> DataFrame:
    """``n`` best (or worst) rows by a measure; rows without the measure do not rank."""
    m = F.col(measure) if isinstance(measure, str) else measure
    ranked = df.where(m.isNotNull() & F.col(tie).isNotNull())
    return ranked.orderBy(m.desc() if top else m.asc(), F.col(tie)).limit(n)
