"""Gold models: calendar, dimensions, facts, marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import date_key, fiscal_quarter, fiscal_year, iso_weekday, month_start, safe_ratio, tier
from tradeloom.operators.aggregates import distinct_members, distributor_month, employee_month_actuals
from tradeloom.operators.bitmaps import activity
from tradeloom.operators.columns import LINEAGE
from tradeloom.operators.joins import asof_scd, date_lookup, full_outer_coalesce, lookup
from tradeloom.operators.keys import assert_pk
from tradeloom.operators.numbering import surrogate
from tradeloom.operators.versions import scd2
from tradeloom.sources.readers import date_spine

Tables = Mapping[str, DataFrame]

# The calendar's range and the credit tiers' lower bounds.
FIRST_DAY, LAST_DAY = "2022-01-01", "2026-12-31"
CUSTOMER_TIERS = (200_000_000, 100_000_000)
DISTRIBUTOR_TIERS = (500_000_000, 200_000_000)


def _placed(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Add derived columns in front of the lineage columns."""
    own = [c for c in df.columns if c not in LINEAGE]
    return df.select(*own, *[c.alias(n) for n, c in new.items()], *LINEAGE)


def calendar(spark: SparkSession, start: str = FIRST_DAY, end: str = LAST_DAY) -> DataFrame:
    """One row per day with calendar and fiscal parts."""
    day = F.col("date_day")
    return date_spine(spark, start, end).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("calendar_year"),
        F.quarter(day).alias("calendar_quarter"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_weekday(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        fiscal_year(day).alias("fiscal_year"),
        fiscal_quarter(day).alias("fiscal_quarter"),
        (iso_weekday(day) >= 6).alias("is_weekend"),
    )


def dim_date(src: Tables) -> DataFrame:
    """The calendar; a catalog that stores tables on first use is not asked for a table just to have its session."""
    spark = getattr(src, "spark", None)
    return calendar(spark or src["raw.sales_transactions"].sparkSession)


def dim_customers(src: Tables) -> DataFrame:
    customers = src["stg_customers"]
    keyed = customers.select(F.col("customer_id").alias("customer_key"), *customers.columns)
    return _placed(keyed, {"credit_limit_tier": tier("credit_limit", *CUSTOMER_TIERS)})


def dim_products(src: Tables) -> DataFrame:
    products = src["stg_products"]
    margin = F.col("unit_price") - F.col("cost_price")
    keyed = products.select(F.col("product_id").alias("product_key"), *products.columns)
    return _placed(keyed, {"unit_margin": margin, "unit_margin_pct": safe_ratio(margin, "unit_price")})


def dim_distributors(src: Tables) -> DataFrame:
    distributors = src["stg_distributors"]
    keyed = distributors.select(F.col("distributor_id").alias("distributor_key"), *distributors.columns)
    return _placed(keyed, {"credit_limit_tier": tier("credit_limit", *DISTRIBUTOR_TIERS)})


def dim_employees(src: Tables) -> DataFrame:
    """One row per employee version, keyed by employee and first day."""
    versions = scd2(src["stg_employees"], "employee_id", "effective_date", "resign_date")
    key = F.concat("employee_id", F.lit("_"), F.date_format("effective_from", "yyyyMMdd"))
    return versions.select(
        key.alias("employee_key"),
        "employee_id", "full_name", "gender", "date_of_birth", "join_date", "position", "region", "team",
        "email", "phone", "status", "version", "effective_from", "effective_to", "is_current", "resign_date",
        "transfer_note", *LINEAGE,
    )


def numbered(src: Tables, name: str, members: DataFrame, order: Sequence[str], key: str) -> DataFrame:
    """Members with their surrogate keys: from the tables' stored maps where they have such, else 1..n by ``order``."""
    maps = getattr(src, "key_maps", None)
    return maps.extend(name, members, order, key) if maps else surrogate(members, order, key)


def dim_regions(src: Tables) -> DataFrame:
    members = distinct_members(src["dim_customers"], ["region"])
    return assert_pk(numbered(src, "regions", members, ["region"], "region_key"), ["region_key"])


def dim_geography(src: Tables) -> DataFrame:
    """Region and province pairs; ``region_key`` is that of the region dimension, which has the same members."""
    members = distinct_members(src["dim_customers"], ["region", "province"])
    keyed = numbered(src, "geography", members, ["region", "province"], "geography_key")
    keyed = keyed.join(src["dim_regions"], "region", "left")
    return assert_pk(keyed.select("geography_key", "region_key", "region", "province"), ["geography_key"])


def dim_channels(src: Tables) -> DataFrame:
    """Channels that occur in sales, so it is built after the sales fact."""
    members = distinct_members(src["fact_sales"], ["channel"])
    return assert_pk(numbered(src, "channels", members, ["channel"], "channel_key"), ["channel_key"])


PLACE = ("region", "province", "channel")


def key_customers(src: Tables) -> DataFrame:
    """Numbers of the customers that occur in sales, those of one place together."""
    buyers = src["fact_sales"].where("customer_id is not null").groupBy("customer_id")
    members = buyers.agg(*[F.min(c).alias(c) for c in PLACE])
    return _numbers(src, "customers", members, PLACE, "customer_id", "customer_no")


def key_orders(src: Tables) -> DataFrame:
    """Numbers of the orders that occur in sales, those of one month and place together."""
    orders = src["fact_sales"].where("order_id is not null").groupBy("order_id")
    members = orders.agg(F.min(month_start("order_date")).alias("month_date"), *[F.min(c).alias(c) for c in PLACE])
    return _numbers(src, "orders", members, ("month_date", *PLACE), "order_id", "order_no")


def _numbers(src: Tables, name: str, members: DataFrame, near: Sequence[str], column: str, key: str) -> DataFrame:
    """A number for each member. Where it was seen first decides its place among new ones, but does not identify it."""
    maps = getattr(src, "key_maps", None)
    if not maps:
        return surrogate(members, [*near, column], key).select(column, key)
    return maps.extend_by(name, members, column, near, key)


def fact_sales(src: Tables) -> DataFrame:
    """Sales lines with dimension keys, cost and profit."""
    lines = asof_scd(
        src["stg_sales_transactions"], src["dim_employees"], "employee_id", "order_date", {"employee_key": "employee_key"}
    )
    lines = lookup(lines, src["dim_customers"], "customer_id", {"customer_key": "customer_key"})
    lines = lookup(lines, src["dim_products"], "product_id", {"product_key": "product_key", "_cost": "cost_price"})
    lines = date_lookup(lines, src["dim_date"], "order_date", "order_date_key")
    cost = F.col("quantity") * F.col("_cost")
    profit = F.col("net_amount") - cost
    return lines.select(
        "order_id", "order_date_key", "customer_key", "product_key", "employee_key",
        "order_date", "customer_id", "employee_id", "product_id",
        "order_month", "order_quarter", "order_year", "region", "province", "channel", "product_category",
        "delivery_status", "payment_method", "payment_status",
        "quantity", "unit_price", "discount_pct", "discount_amount", "gross_amount", "net_amount",
        cost.cast("decimal(28,4)").alias("total_cost"),
        profit.cast("decimal(28,4)").alias("gross_profit"),
        safe_ratio(profit, "net_amount").alias("gross_profit_margin_pct"),
        *LINEAGE,
    )


def fact_returns(src: Tables) -> DataFrame:
    """Returns with dimension keys and their effect on margin."""
    rows = asof_scd(
        src["stg_return_transactions"], src["dim_employees"], "employee_id", "return_date", {"employee_key": "employee_key"}
    )
    rows = lookup(rows, src["dim_customers"], "customer_id", {"customer_key": "customer_key"})
    rows = lookup(rows, src["dim_products"], "product_id", {"product_key": "product_key", "_cost": "cost_price"})
    rows = date_lookup(rows, src["dim_date"], "return_date", "return_date_key")
    cost = F.col("return_quantity") * F.col("_cost")
    return rows.select(
        "return_id", "original_order_id", "return_date_key", "customer_key", "product_key", "employee_key",
        "return_date", "return_month", "customer_id", "employee_id", "product_id", "region", "province",
        "return_reason", "status", "return_quantity", "unit_price", "return_amount",
        cost.cast("decimal(28,4)").alias("return_cost_amount"),
        (F.col("return_amount") - cost).cast("decimal(28,4)").alias("return_margin_impact"),
        *LINEAGE,
    )


def fact_targets(src: Tables) -> DataFrame:
    """Targets of the latest plan version with dimension keys."""
    rows = src["stg_sales_targets_versioned"].where("is_latest").withColumnsRenamed(
        {"effective_from": "plan_from", "effective_to": "plan_to"}
    )
    rows = asof_scd(rows, src["dim_employees"], "employee_id", "target_month_date", {"employee_key": "employee_key"})
    rows = date_lookup(rows, src["dim_date"], "target_month_date", "target_date_key")
    return rows.select(
        "target_date_key", "employee_key", "employee_id", "employee_name", "target_year", "target_month",
        "month_col", "target_month_date", "version_label", "version_rank", "version_date",
        F.col("plan_from").alias("effective_from"), F.col("plan_to").alias("effective_to"), "is_latest",
        "region", "team", "target_revenue", "target_quantity", "target_new_customers", *LINEAGE,
    )


def fact_distributor_orders(src: Tables) -> DataFrame:
    """Distributor order lines with dimension keys, fill rate and punctuality.

    The on-time flag is unknown when either date is missing; it is independent
    of what the source says about punctuality.
    """
    rows = lookup(src["stg_distributor_orders"], src["dim_distributors"], "distributor_id", {"distributor_key": "distributor_key"})
    rows = lookup(rows, src["dim_products"], "product_id", {"product_key": "product_key"})
    for role in ("order_date", "expected_delivery_date", "actual_delivery_date"):
        rows = date_lookup(rows, src["dim_date"], role, f"{role}_key")
    return rows.select(
        "order_id", "order_date_key", "distributor_key", "product_key", "order_date", "order_month",
        "order_quarter", "distributor_id", "product_id", "region", "channel", "product_category",
        "on_time_delivery", "delivery_status", "payment_terms", "expected_delivery_date_key",
        "actual_delivery_date_key", "expected_delivery_date", "actual_delivery_date", "qty_ordered",
        "qty_delivered", "fill_rate_pct", "unit_price_list", "distributor_price", "gross_amount",
        "delivered_amount",
        safe_ratio("qty_delivered", "qty_ordered").alias("calculated_fill_rate_pct"),
        (F.col("actual_delivery_date") <= F.col("expected_delivery_date")).alias("calculated_on_time_delivery"),
        *LINEAGE,
    )


def mart_sales_vs_target(src: Tables) -> DataFrame:
    """Actuals beside targets per employee and month.

    Descriptions come from the target side only. A missing side counts as 0, but
    an achievement exists only where there is a target other than 0.
    """
    targets = src["fact_targets"].select(
        "employee_id", F.col("target_month_date").alias("month_date"), "employee_name", "target_year",
        "target_month", "region", "team", "version_label", "target_revenue", "target_quantity",
        "target_new_customers",
    )
    actuals = employee_month_actuals(src["fact_sales"], by_group=getattr(src, "by_group", False))
    both = full_outer_coalesce(targets, actuals, {"employee_id": "employee_id", "month_date": "sales_month_date"}, apart=("employee_id", "sales_month_date"))

    def or_zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    return both.select(
        "employee_id", "employee_name", "month_date",
        F.coalesce("target_year", "sales_year").alias("year"),
        F.coalesce("target_month", "sales_month").alias("month"),
        "region", "team", "version_label",
        or_zero("total_orders").alias("total_orders"),
        or_zero("active_customers").alias("active_customers"),
        or_zero("actual_quantity").alias("actual_quantity"),
        or_zero("target_quantity").alias("target_quantity"),
        (or_zero("actual_quantity") - or_zero("target_quantity")).alias("quantity_gap"),
        safe_ratio(or_zero("actual_quantity"), "target_quantity").alias("quantity_achievement_pct"),
        or_zero("actual_revenue").alias("actual_revenue"),
        or_zero("target_revenue").alias("target_revenue"),
        (or_zero("actual_revenue") - or_zero("target_revenue")).alias("revenue_gap"),
        safe_ratio(or_zero("actual_revenue"), "target_revenue").alias("revenue_achievement_pct"),
        or_zero("actual_total_cost").alias("actual_total_cost"),
        or_zero("actual_gross_profit").alias("actual_gross_profit"),
        safe_ratio("actual_gross_profit", "actual_revenue").alias("actual_gross_profit_margin_pct"),
        or_zero("target_new_customers").alias("target_new_customers"),
    )


def mart_distributor_performance(src: Tables) -> DataFrame:
    """Fulfilment per distributor, month, region and channel.

    On-time deliveries are set against all records with a delivery status, so
    undelivered records lower the rate.
    """
    totals = distributor_month(
        src["fact_distributor_orders"], src["dim_distributors"], by_group=getattr(src, "by_group", False)
    )
    return totals.select(
        "distributor_id", "distributor_name", "tier", "distributor_channel", "province", "distributor_region",
        "month_date", "year", "month", "order_region", "order_channel", "total_orders", "products_ordered",
        "total_qty_ordered", "total_qty_delivered",
        safe_ratio("total_qty_delivered", "total_qty_ordered").alias("fill_rate_pct"),
        "total_gross_amount", "total_delivered_amount",
        safe_ratio("total_delivered_amount", "total_gross_amount").alias("delivered_amount_rate_pct"),
        "on_time_delivery_count", "late_delivery_count", "delivery_record_count", "order_record_count",
        safe_ratio("on_time_delivery_count", "delivery_record_count").alias("on_time_delivery_rate_pct"),
    )


def mart_sales_activity(src: Tables) -> DataFrame:
    """Buying customers and orders as bitmaps of their numbers, with sales, per month and place.

    Any grouping of these columns has its distinct counts from here, without the fact: ``roll_up``.
    """
    lines = src["fact_sales"]
    lines = lookup(lines, src["key_customers"], "customer_id", {"customer_no": "customer_no"})
    lines = lookup(lines, src["key_orders"], "order_id", {"order_no": "order_no"})
    by = {"month_date": month_start("order_date"), **{c: F.col(c) for c in PLACE}}
    sums = {"revenue": "net_amount", "gross_profit": "gross_profit", "units_sold": "quantity"}
    return activity(lines, by, {"customers": "customer_no", "orders": "order_no"}, sums)


# The date each order-line fact is read by.
FACT_DATES = {"fact_sales": "order_date", "fact_returns": "return_date", "fact_distributor_orders": "order_date"}

# Tables of order lines, with the date that orders within a bucket of orders.
ORDER_DATES = {n: "order_date" for n in ("stg_sales_transactions", "stg_distributor_orders", "fact_sales", "fact_distributor_orders")}

# In build order: the channel dimension reads the sales fact.
GOLD_MODELS = {
    "dim_date": dim_date,
    "dim_customers": dim_customers,
    "dim_products": dim_products,
    "dim_distributors": dim_distributors,
    "dim_employees": dim_employees,
    "dim_regions": dim_regions,
    "dim_geography": dim_geography,
    "fact_sales": fact_sales,
    "fact_returns": fact_returns,
    "fact_targets": fact_targets,
    "fact_distributor_orders": fact_distributor_orders,
    "dim_channels": dim_channels,
    "key_customers": key_customers,
    "key_orders": key_orders,
    "mart_sales_activity": mart_sales_activity,
    "mart_sales_vs_target": mart_sales_vs_target,
    "mart_distributor_performance": mart_distributor_performance,
}
