"""The physical plans the operators are meant to get, and behaviour under a hot key."""

import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import aggregates, joins, keys, versions
from tradeloom.plans import gold, measures, quality
from tradeloom.workload.queries import QUERIES

PYTHON_NODES = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution ran it."""
    df.collect()
    return plan(df)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_dedupe_keeps_one_row_per_key_before_the_shuffle(tables):
    text = plan(tables.plan("stg_sales_transactions"))
    before, after = text.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert text.count("Exchange") == 1


def test_unique_check_after_dedupe_shuffles_only_the_keys(tables):
    source = tables["raw.customer_master"].select("customer_id", "_ingested_at")
    text = plan(keys.duplicate_keys(keys.dedupe_latest(source, ["customer_id"]), ["customer_id"]))
    assert text.count("Exchange hashpartitioning") == 1  # the dedupe's own


def test_models_use_no_python_workers(tables):
    for name in ("stg_sales_transactions", "stg_sales_targets_versioned", "fact_sales", "fact_distributor_orders", "mart_sales_vs_target", "mart_sales_activity"):
        assert not any(node in plan(tables.plan(name)) for node in PYTHON_NODES)


def test_mart_reads_only_its_columns(tables):
    text = plan(aggregates.employee_month_actuals(tables["fact_sales"]))
    scans = re.findall(r"FileScan parquet \[(.*?)\]", text)
    read = [{re.sub(r"#\d+L?", "", c) for c in scan.split(",")} for scan in scans]
    assert len(read) == 1  # both distinct counts and the sums
    assert read[0] == {
        "order_id", "order_date", "customer_id", "employee_id", "quantity", "discount_amount", "gross_amount", "net_amount", "total_cost", "gross_profit",
    }


def test_slicers_reach_the_scan(tables):
    spark = tables.spark
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    lines = measures.slice_rows(measures.year_of_sales(tables["fact_sales"], 2024), region="ASIA")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(lines)).group(1)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for part in ("GreaterThanOrEqual(order_date,2024-01-01)", "LessThan(order_date,2025-01-01)", "EqualTo(region,ASIA)"):
        assert part in pushed


def test_small_dimensions_are_broadcast_without_moving_the_fact(tables):
    text = plan(tables.plan("fact_sales"))
    assert text.count("BroadcastHashJoin") == 4 and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text


def test_interval_join_is_a_hash_join_with_a_residual(tables):
    text = plan(QUERIES["join_scd_asof"](tables))
    assert re.search(r"BroadcastHashJoin \[employee_id#\d+\], \[_id#\d+\], LeftOuter, BuildRight, \(\(order_date", text)
    assert "NestedLoop" not in text


def test_role_dates_share_one_broadcast(tables):
    text = final_plan(QUERIES["join_role_dates"](tables)).split("Initial Plan")[0]
    assert text.count("ReusedExchange") == 2


def test_large_dimensions_are_sort_merged(tables, no_broadcast):
    text = plan(tables.plan("fact_sales"))
    assert text.count("SortMergeJoin") == 3  # customers, products, employees
    assert text.count("BroadcastHashJoin") == 1  # the calendar, of fixed size
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_results_do_not_depend_on_the_join_strategy(tables, no_broadcast):
    merged = tables.plan("fact_sales")
    assert merged.exceptAll(tables["fact_sales"]).isEmpty()


def test_share_of_total_gathers_no_rows(tables):
    text = plan(measures.revenue_contribution(tables["mart_distributor_performance"]))
    assert "Window" not in text


def test_hot_key_in_a_lookup_is_split(spark, no_broadcast):
    """A third of the fact on one key: adaptive execution splits its partition."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 400_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 5000) as k", "id", "uuid() as filler")
        dim = spark.range(5000).selectExpr("id as k", "id * 2 as cost")
        looked_up = joins.lookup(fact, dim, "k", {"cost": "cost"})
        text = final_plan(looked_up).split("Initial Plan")[0]
        assert "skew=true" in text or "SortMergeJoin(skew" in text
        assert looked_up.where("cost = 14").count() == 400_000 // 3 + 1 + sum(1 for i in range(7, 400_000, 5000) if i % 3)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_hot_group_of_versions_is_spread(spark):
    """All rows in one group: the group is one row per task, and rows meet it by their identity, which no two share."""
    rows = spark.range(0, 20_000, 1, 8).selectExpr("'hot' as emp", "id as rank", "cast(id as string) as label")
    flagged = versions.flag_latest(rows, ["emp"], ["rank"], ["label"])
    assert flagged.where("is_latest").select("rank").collect() == [(19_999,)]
    text = plan(flagged)
    assert "Window" not in text and "partial_max" in text
    assert not re.search(r"Exchange hashpartitioning\(emp#\d+, \d+\)", text)


def test_marts_shuffle_combined_rows_alone(tables):
    """The fact is scanned once; its rows are expanded and combined in the scan's stage, before anything is shuffled."""
    for name, column in (("agg_employee_month", "net_amount"), ("agg_distributor_month", "qty_ordered")):
        text = plan(QUERIES[name](tables))
        assert len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", text)) == 1
        assert text.count("Expand") == 1
        shuffled, expanded = text[: text.index("Expand")].rsplit("Exchange hashpartitioning", 1)
        assert "HashAggregate" in expanded and "HashAggregate" in shuffled


def test_a_profile_scans_its_table_once(tables):
    from tradeloom.plans import quality
    from tradeloom.sources.specs import PROFILED

    text = plan(quality.profile_table("customer_master", tables["raw.customer_master"], PROFILED["customer_master"]))
    assert text.count("FileScan") == 1


def test_null_keys_of_a_full_join_are_spread(spark, no_broadcast):
    left = spark.range(0, 10_000).selectExpr("if(id % 2 = 0, null, id) as k", "id as l")
    right = spark.range(0, 10_000).selectExpr("if(id % 3 = 0, null, id) as k", "id as r")
    joined = joins.full_outer_coalesce(left, right, {"k": "k"})
    both = {i for i in range(10_000) if i % 2 and i % 3}
    assert joined.count() == 20_000 - len(both)
    assert joined.where("l is not null and r is not null").count() == len(both)


def test_asof_buckets_need_no_cross_join(tables):
    text = plan(QUERIES["join_scd_asof_bucketed"](tables))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_calendar_is_small(spark):
    assert gold.calendar(spark).count() < 2000


def test_merged_asof_of_a_hot_id(spark, no_broadcast):
    """The window sees an id's different dates, not its events; the events are dealt by (id, date)."""
    events = spark.range(200_000).select(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("e"), F.col("id"))).alias("who"),
                                         F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("d"))
    dim = spark.createDataFrame([("hot", "2024-02-01", "2024-03-01", 1), ("hot", "2024-03-02", "9999-12-31", 2)], "who string, f string, t string, n int")
    dim = dim.select("who", F.col("f").cast("date").alias("effective_from"), F.col("t").cast("date").alias("effective_to"), "n")
    joined = joins.asof_merge(events, dim, "who", "d", {"n": "n"})
    text = final_plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert re.search(r"hashpartitioning\(who#\d+, d#\d+", text) and re.search(r"hashpartitioning\(_id#\d+, 3\)", text)
    seen = {r.n: r["count"] for r in joined.where("who = 'hot'").groupBy("n").count().collect()}
    assert sum(seen.values()) == 180_000 and set(seen) == {None, 1, 2}


def test_row_rules_of_a_table_share_a_scan(tables):
    """Of all checks of both layers, each table is scanned once for its row rules."""
    rules = [r for check in (*quality.SILVER_CHECKS, *quality.GOLD_CHECKS) if isinstance(check, quality.RowChecks) for r in check.rules]
    names = {r.table for r in rules}
    assert len(rules) > 1.5 * len(names)
    assert plan(quality.rule_report({t: tables[t] for t in names}, rules)).count("FileScan") == len(names)
