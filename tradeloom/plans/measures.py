"""Dashboard measures and views: ratios of sums over any grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import month_start, safe_ratio
from tradeloom.operators.aggregates import share_of_total, top_n
from tradeloom.operators.bitmaps import roll_up
from tradeloom.session import ensure_checkpoint_dir

RANKED_EMPLOYEES = 10


def slice_rows(
    df: DataFrame, year: int | None = None, region: str | None = None, channel: str | None = None,
    province: str | None = None, year_of: str = "year",
) -> DataFrame:
    """Dashboard slicers, as filters that reach the scan."""
    wanted = {year_of: year, "region": region, "channel": channel, "province": province}
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == F.lit(value))
    return df


def year_of_sales(fact: DataFrame, year: int, date: str = "order_date") -> DataFrame:
    """Sales of one calendar year, as a date range so that row groups can be skipped."""
    day = F.col(date)
    return fact.where((day >= F.lit(f"{year}-01-01").cast("date")) & (day < F.lit(f"{year + 1}-01-01").cast("date")))


def sales_overview(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Revenue against target, and margin."""
    return (
        mart.groupBy(*by)
        .agg(
            F.sum("actual_revenue").alias("total_actual_revenue"),
            F.sum("target_revenue").alias("total_target_revenue"),
            F.sum("actual_gross_profit").alias("gross_profit"),
        )
        .withColumns(
            {
                "revenue_gap": F.col("total_actual_revenue") - F.col("total_target_revenue"),
                "revenue_achievement_pct": safe_ratio("total_actual_revenue", "total_target_revenue"),
                "gross_profit_margin_pct": safe_ratio("gross_profit", "total_actual_revenue"),
            }
        )
    )


def units_overview(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Units against target."""
    return (
        mart.groupBy(*by)
        .agg(F.sum("actual_quantity").alias("total_units_sold"), F.sum("target_quantity").alias("target_units"))
        .withColumns(
            {
                "units_gap": F.col("total_units_sold") - F.col("target_units"),
                "units_achievement_pct": safe_ratio("total_units_sold", "target_units"),
            }
        )
    )


def active_customers(fact_sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct buying customers, counted on the fact for groupings that no mart has."""
    return fact_sales.groupBy(*by).agg(F.count_distinct("customer_id").alias("active_customers"))


def sales_activity(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct buying customers and orders beside sales, for any slicer, from the activity mart alone."""
    counted = {"customers": "active_customers", "orders": "total_orders"}
    return roll_up(mart, by, counted, ("revenue", "gross_profit", "units_sold"))


def distributor_overview(mart: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Order value, fulfilment and punctuality of distributors."""
    return (
        mart.groupBy(*by)
        .agg(
            F.sum("order_record_count").alias("distributor_orders"),
            F.sum("total_orders").alias("distinct_orders"),
            F.sum("total_gross_amount").alias("gross_order_value"),
            F.sum("total_delivered_amount").alias("delivered_revenue"),
            F.sum("total_qty_ordered").alias("qty_ordered"),
            F.sum("total_qty_delivered").alias("qty_delivered"),
            F.sum("on_time_delivery_count").alias("on_time_deliveries"),
            F.sum("late_delivery_count").alias("late_deliveries"),
            F.sum("delivery_record_count").alias("delivery_records"),
        )
        .withColumns(
            {
                "quantity_fill_rate_pct": safe_ratio("qty_delivered", "qty_ordered"),
                "on_time_delivery_rate_pct": safe_ratio("on_time_deliveries", "delivery_records"),
            }
        )
    )


def revenue_contribution(mart: DataFrame, by: Sequence[str] = ("distributor_id",)) -> DataFrame:
    """Each member's share of all delivered revenue, in percent."""
    delivered = mart.groupBy(*by).agg(F.sum("total_delivered_amount").alias("delivered_revenue"))
    return share_of_total(delivered, "delivered_revenue", "revenue_contribution_pct")


def revenue_by(fact_sales: DataFrame, by: Sequence[str]) -> DataFrame:
    """Revenue, profit and margin of the sales fact; no target exists at this level."""
    return (
        fact_sales.groupBy(*by)
        .agg(
            F.sum("net_amount").alias("revenue"),
            F.sum("gross_profit").alias("gross_profit"),
            F.sum("quantity").alias("units_sold"),
        )
        .withColumn("gross_profit_margin_pct", safe_ratio("gross_profit", "revenue"))
    )


def revenue_levels(fact_sales: DataFrame, levels: Sequence[str] = ("region", "province")) -> DataFrame:
    """Revenue of a drill-down at all of its levels, from one scan; ``level`` is how many columns a row is grouped by.

    A member that is NULL has the level of members, a total that of totals. An empty table has no rows at any level.
    """
    rolled = fact_sales.rollup(*levels).agg(
        (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int").alias("level"),
        F.sum("net_amount").alias("revenue"),
        F.sum("gross_profit").alias("gross_profit"),
        F.sum("quantity").alias("units_sold"),
    )
    return rolled.withColumn("gross_profit_margin_pct", safe_ratio("gross_profit", "revenue"))


def revenue_trend(fact_sales: DataFrame) -> DataFrame:
    """Revenue and margin per month."""
    return revenue_by(fact_sales.withColumn("month_date", month_start("order_date")), ["month_date"]).orderBy("month_date")


def target_performance(mart: DataFrame, by: Sequence[str]) -> DataFrame:
    """Revenue against target per month or region."""
    return sales_overview(mart, by).select(
        *by, "total_actual_revenue", "total_target_revenue", "revenue_gap", "revenue_achievement_pct"
    )


def employee_detail(mart: DataFrame, year: int | None = None) -> DataFrame:
    """One row per employee: revenue, units and profit against target, over all years unless one is given.

    Name, region and team are those of one row: the newest month that names the employee.
    """
    rows = slice_rows(mart, year=year)
    who = ["employee_name", "region", "team"]
    newest = F.format_string("%05d%03d|%s|%s|%s", "year", "month", *[F.coalesce(c, F.lit("")) for c in who])
    named = F.max_by(F.struct(*who), F.when(F.col("employee_name").isNotNull(), newest)).alias("_who")
    totals = rows.groupBy("employee_id").agg(
        named,
        F.sum("actual_revenue").alias("actual_revenue"),
        F.sum("target_revenue").alias("target_revenue"),
        F.sum("actual_quantity").alias("actual_quantity"),
        F.sum("target_quantity").alias("target_quantity"),
        F.sum("actual_gross_profit").alias("actual_gross_profit"),
    )
    measures = [c for c in totals.columns if c not in ("employee_id", "_who")]
    return totals.select("employee_id", *[F.col(f"_who.{c}").alias(c) for c in who], *measures).withColumns(
        {
            "revenue_gap": F.col("actual_revenue") - F.col("target_revenue"),
            "revenue_achievement_pct": safe_ratio("actual_revenue", "target_revenue"),
            "units_achievement_pct": safe_ratio("actual_quantity", "target_quantity"),
            "gross_profit_margin_pct": safe_ratio("actual_gross_profit", "actual_revenue"),
        }
    )


def rank_employees(
    mart: DataFrame, by: Column | str = "revenue_achievement_pct", n: int = RANKED_EMPLOYEES, top: bool = True,
    year: int | None = None,
) -> DataFrame:
    """Best or worst employees by a measure of ``employee_detail``."""
    return top_n(employee_detail(mart, year), by, "employee_id", n, top)


def fulfilment_by(mart: DataFrame, by: Sequence[str]) -> DataFrame:
    """Fill rate, punctuality and late deliveries beside the volume they belong to."""
    return distributor_overview(mart, by).select(
        *by, "delivered_revenue", "quantity_fill_rate_pct", "on_time_delivery_rate_pct", "late_deliveries", "delivery_records"
    )


def distributor_priority(mart: DataFrame) -> DataFrame:
    """Distributors to act on first: at least an average share of revenue, punctuality below the overall rate.

    Both yardsticks come from one row of totals over the distributors' own sums, read as a scalar subquery. The sums
    are written once for both readers, so that a mart which comes straight from its model is made once.
    """
    ensure_checkpoint_dir(mart.sparkSession)
    per_distributor = mart.groupBy("distributor_id", "distributor_name").agg(
        F.sum("total_delivered_amount").alias("delivered_revenue"),
        F.sum("total_qty_ordered").alias("qty_ordered"),
        F.sum("total_qty_delivered").alias("qty_delivered"),
        F.sum("on_time_delivery_count").alias("on_time_deliveries"),
        F.sum("delivery_record_count").alias("delivery_records"),
    ).checkpoint()
    overall = per_distributor.agg(
        F.struct(
            F.sum("delivered_revenue").alias("revenue"),
            F.count_distinct("distributor_id").alias("members"),
            safe_ratio(F.sum("on_time_deliveries"), F.sum("delivery_records")).alias("on_time"),
        )
    ).scalar()
    measured = per_distributor.withColumn("_overall", overall).withColumns(
        {
            "revenue_contribution_pct": safe_ratio("delivered_revenue", F.col("_overall.revenue"), scale=4),
            "quantity_fill_rate_pct": safe_ratio("qty_delivered", "qty_ordered"),
            "on_time_delivery_rate_pct": safe_ratio("on_time_deliveries", "delivery_records"),
        }
    )
    important = F.col("delivered_revenue") * F.col("_overall.members") >= F.col("_overall.revenue")
    unreliable = F.col("on_time_delivery_rate_pct") < F.col("_overall.on_time")
    return (
        measured.where(important & unreliable)
        .select(
            "distributor_id", "distributor_name", "delivered_revenue", "revenue_contribution_pct",
            "quantity_fill_rate_pct", "on_time_delivery_rate_pct",
        )
        .orderBy(F.col("delivered_revenue").desc(), "distributor_id")
    )
