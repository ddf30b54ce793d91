"""Queries that pass once through the order tables: nothing of these is stored, and only what is needed is moved."""

import re

import pytest
from pyspark.sql import functions as F

from test_scale import JIT_BYTES, method_sizes

from tradeloom.operators import aggregates, keys
from tradeloom.plans import catalog, measures, silver
from tradeloom.workload import queries

FOLDER = "/root/testdata/sf0.001"
LINE_SOURCES = {f"raw.{t}" for t in ("sales_transactions", "distributor_orders", "return_transactions")}
LINE_TABLES = LINE_SOURCES | {n for n in catalog.MODELS if n.startswith("fact_") and n != "fact_targets"} | {
    "stg_sales_transactions", "stg_distributor_orders", "stg_return_transactions", "mart_sales_vs_target", "mart_distributor_performance",
}


def text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stores_no_lines(spark, tables, name):
    """The query stores no table of order lines, and returns what it does where all tables are stored."""
    cat = queries.BoundCatalog(spark, FOLDER)
    found = queries.QUERIES[name](cat)
    rows = found.collect()
    assert not LINE_TABLES & set(cat._stored)
    for table in LINE_TABLES:
        tables[table]
    stored = queries.QUERIES[name](tables)
    assert found.schema.names == stored.schema.names and sorted(map(str, rows)) == sorted(map(str, stored.collect())) and rows
    return found


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("source", ["sales_transactions", "distributor_orders"])
def test_parts_are_joined_before_the_orders(spark, no_broadcast, source):
    """The exchange by part moves lines alone, no cells of their order or customer."""
    found = text(queries.Bindings(spark, FOLDER).sources()[f"raw.{source}"]())
    moved = re.findall(r"Exchange hashpartitioning\(l_partkey#[^\n]*\n(.*?FileScan[^\n]*)", found, re.DOTALL)
    assert moved and not any("o_orderkey" in rows for rows in moved)


def test_rows_that_are_alike_travel_together(spark):
    lines = spark.range(0, 4_000, 1, 4).selectExpr(
        "cast(id % 300 as string) as o", "cast(id % 7 as string) as p", "if(id % 5 = 0, null, id) as at", "if(id % 11 = 0, null, id) as x"
    )
    found = keys.dedupe_latest(lines, ["o", "p"], ["at"], together=["o"])
    plain = keys.dedupe_latest(lines, ["o", "p"], ["at"])
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    assert len(re.findall(r"Exchange hashpartitioning\(o#\d+, \d+\)", text(found))) == 1 == text(found).count("Exchange")


@pytest.mark.parametrize("name", sorted(catalog.TOGETHER))
def test_straight_rows_are_compiled_by_the_jvm(spark, capsys, name):
    cat = queries.BoundCatalog(spark, FOLDER)
    for df in (catalog.Straight(cat, (name,))[name], catalog.SilverKeys(cat)[name]):
        sizes = method_sizes(df, capsys)
        assert sizes and max(sizes) <= JIT_BYTES


def test_revenue_drilldown(spark, tables, no_broadcast):
    found = text(stores_no_lines(spark, tables, "revenue_drilldown"))
    assert "cost_price#" in found and "_customer_id#" not in found  # costs are needed, customer keys are not


def test_agg_filter_count(spark, tables, no_broadcast):
    found = text(stores_no_lines(spark, tables, "agg_filter_count"))
    assert "_product_id#" not in found and "_distributor_id#" not in found


def test_join_full_outer(spark, tables):
    stores_no_lines(spark, tables, "join_full_outer")


@pytest.mark.parametrize("name", ["target_by_region", "target_by_month"])
def test_targets(spark, tables, name):
    stores_no_lines(spark, tables, name)


def test_kpi_sales_overview(spark, tables):
    stores_no_lines(spark, tables, "kpi_sales_overview")


def test_key_customers(spark, tables):
    stores_no_lines(spark, tables, "key_customers")


def test_dq_fill_rate_bounds(spark, tables):
    found = text(stores_no_lines(spark, tables, "dq_fill_rate_bounds"))
    assert "Expand" not in found  # no distinct counts for a rate


def test_distributor_action_priority(spark, tables):
    found = stores_no_lines(spark, tables, "distributor_action_priority")
    assert "FileScan" not in text(found)  # the mart is read once, its sums twice


def test_priority_over_a_mart_of_its_own(spark):
    rows = [("a", "A", 90, 10, 9, 1, 10), ("b", "B", 50, 10, 10, 9, 10), ("c", "C", 1, 1, 1, 0, 10), ("a", "A", 10, 10, 9, 1, 10), (None, None, 5, 1, 1, 1, 1)]
    names = "total_delivered_amount total_qty_ordered total_qty_delivered on_time_delivery_count delivery_record_count"
    mart = spark.createDataFrame(rows, "distributor_id string, distributor_name string, " + ", ".join(f"{n} int" for n in names.split()))
    mart = mart.withColumns({n: F.col(n).cast("decimal(18,4)") for n in names.split()})
    found = measures.distributor_priority(mart).collect()
    assert [(r.distributor_id, float(r.delivered_revenue), float(r.on_time_delivery_rate_pct)) for r in found] == [("a", 100.0, 10.0)]


def test_mart_distributor_performance(spark, tables):
    found = text(stores_no_lines(spark, tables, "mart_distributor_performance")).split("Initial Plan")[0]
    assert "Expand" not in found


def test_totals_within_groups(spark):
    lines = spark.range(0, 6_000, 1, 4).selectExpr(
        "if(id % 13 = 0, null, id % 5) as g", "date_add(date '2024-01-01', cast(id % 90 as int)) as d", "if(id % 17 = 0, null, id div 4) as o",
        "if(id % 7 = 0, null, id % 50) as c", "if(id % 19 = 0, null, cast(id as decimal(18,4))) as v", "if(id % 3 = 0, null, id % 2 = 0) as f",
    )
    what = ({"g": F.col("g"), "m": F.trunc("d", "month")}, ("o", "orders"), ("c", "customers"), {"total": "v"}, {"flagged": F.col("f"), "rows": F.lit(True)})
    plain, found = aggregates.totals_with_distinct(lines, *what), aggregates.totals_in_groups(lines, *what)
    found = found.select(plain.columns)
    assert found.dtypes == plain.dtypes and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty() and plain.count() == 18
    assert text(found).split("Initial Plan")[0].count("Exchange") == 1
    empty = aggregates.totals_in_groups(lines.where("g > 9"), *what)
    assert empty.isEmpty()


def test_mart_sales_vs_target(spark, tables):
    found = text(stores_no_lines(spark, tables, "mart_sales_vs_target")).split("Initial Plan")[0]
    assert "Expand" not in found


def test_agg_employee_month(spark, tables):
    found = text(stores_no_lines(spark, tables, "agg_employee_month")).split("Initial Plan")[0]
    assert "Expand" not in found


def raw_customers(spark, *rows):
    """Rows of (id, join date, credit limit, status, load time)."""
    columns = silver.SPECS["stg_customers"].columns
    given = spark.createDataFrame(rows, "customer_id string, join_date string, credit_limit string, status string, _ingested_at timestamp_ntz")
    others = {c: F.lit(None).cast("string") for c in (*columns, "_source_file", "_source_platform", "_batch_id") if c not in given.columns}
    return given.withColumns(others)


def test_keys_are_those_of_the_model(spark):
    from datetime import datetime

    first, then = datetime(2024, 1, 1), datetime(2024, 1, 2)
    spec, good = silver.SPECS["stg_customers"], [
        ("1", "2024-01-01", "5", "x", first), (" 1 ", "2024-01-01", "5", "y", first), ("1", None, None, None, then), ("2", None, "7", "x", None),
        ("2", None, "7", "x", None), ("nan", None, None, "x", first), (None, None, None, "x", first), ("", None, None, "x", first), ("3", None, None, None, then),
    ]
    raw = raw_customers(spark, *good)
    found = silver.silver_keys(spec, raw)
    assert sorted(found.collect()) == sorted(silver.silver(spec, raw).select("customer_id").collect()) == [("1",), ("2",), ("3",)]
    assert text(found).split("Initial Plan")[0].count("Exchange") == 1
    for bad in (("4", "no date", None, None, first), ("4", None, "1.23456", None, first)):
        with pytest.raises(Exception, match="date|decimals"):  # a cell beyond the key is still read
            silver.silver_keys(spec, raw_customers(spark, bad)).collect()


def test_dq_silver_not_null(spark, tables):
    stores_no_lines(spark, tables, "dq_silver_not_null")


def test_rows_that_break_the_rules(spark):
    df = spark.createDataFrame([("13", 1), ("25", 2), ("7", 3), (None, 4), ("5", None)], "k string, v int")
    dirty = queries.DirtyTables({"t": df, "u": df}, {"t": ("k",)})
    expected = [("13", 1), ("13", 1), ("25", 2), (None, 2), ("7", 3), (None, 4), ("5", None), (None, None)]
    assert sorted(dirty["t"].collect(), key=str) == sorted(expected, key=str)
    assert dirty["t"].columns == df.columns and dirty["u"] is df and text(dirty["t"]).count("Scan") == 1


def test_dq_silver_not_null_dirty(spark, tables):
    stores_no_lines(spark, tables, "dq_silver_not_null_dirty")


def test_dq_silver_unique(spark, tables):
    stores_no_lines(spark, tables, "dq_silver_unique")


def test_dq_silver_unique_dirty(spark, tables):
    stores_no_lines(spark, tables, "dq_silver_unique_dirty")


def test_profile_key_nulls(spark, tables, no_broadcast):
    found = text(stores_no_lines(spark, tables, "profile_key_nulls"))
    assert "l_extendedprice" not in found


def test_bronze_row_counts(spark, tables, no_broadcast):
    found = text(stores_no_lines(spark, tables, "bronze_row_counts"))
    assert "l_extendedprice" not in found and "p_type" not in found


@pytest.mark.parametrize("source", ["sales_transactions", "distributor_orders"])
def test_price_and_rebate_are_not_shuffled(spark, no_broadcast, source):
    found = text(queries.Bindings(spark, FOLDER).sources()[f"raw.{source}"]())
    moved = re.findall(r"Exchange hashpartitioning\(l_orderkey#[^\n]*\n[^\n]*Project \[([^\n]*)\]", found)
    assert moved and not any(re.search(r"AS (price|rebate)#", cells) for cells in moved)


def test_dq_gold_row_counts(spark, tables):
    """Facts and marts are counted as they are made; dimensions row by row."""
    stores_no_lines(spark, tables, "dq_gold_row_counts")
    cat = queries.BoundCatalog(spark, FOLDER)
    twice = cat["dim_customers"].unionByName(cat["dim_customers"])
    cat._stored["dim_customers"] = twice
    counted = {r.test_name: r.value for r in queries.QUERIES["dq_gold_row_counts"](cat).collect()}
    assert counted["dim_customers row count"] == twice.count()


def test_dq_on_write(spark, tables):
    stores_no_lines(spark, tables, "dq_on_write")


@pytest.mark.parametrize("name", ["agg_distributor_month_by_order", "dq_order_keys_by_bucket"])
def test_tables_go_to_their_buckets_from_their_models(spark, tables, name):
    stores_no_lines(spark, tables, name)
