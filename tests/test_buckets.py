"""Tables in buckets of orders: same rows, no exchange by the bucketed key, safe refreshes."""

import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import aggregates, keys
from tradeloom.plans import quality
from tradeloom.plans.catalog import build, order_layout
from tradeloom.sources.buckets import Buckets
from tradeloom.workload.queries import QUERIES

LINES = "order_id string, product_id string, who string, month date, customer string, amount decimal(10,2), late boolean"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines(spark):
    """A hot order, orders of two customers and two months, NULL orders and customers, repeated rows."""
    k = F.col("id")
    rows = spark.range(0, 6000, 1, 6).select(
        F.when(k % 3 == 0, "hot").when(k % 17 != 0, F.concat(F.lit("o"), k % 700)).alias("order_id"),
        F.concat(F.lit("p"), k % 40).alias("product_id"), F.concat(F.lit("e"), k % 5).alias("who"),
        F.when(k % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-02-01")).cast("date").alias("month"),
        F.when(k % 11 != 0, F.concat(F.lit("c"), k % 90)).alias("customer"),
        F.when(k % 13 != 0, k / 7).cast("decimal(10,2)").alias("amount"), (k % 4 == 0).alias("late"),
    )
    return rows.union(rows.where("order_id = 'o5'"))


def totals(of, df):
    return of(
        df, {"who": F.col("who"), "month": F.col("month")}, ("order_id", "orders"), ("customer", "customers"),
        {"total": "amount"}, {"late": F.col("late"), "rows": F.lit(True)},
    )


@pytest.fixture
def stored(spark, warehouse):
    return warehouse.materialize(lines(spark), "dwh", "lines", buckets=Buckets(("order_id",), 8, ("month",)))


def test_rows_and_buckets_are_kept(spark, warehouse, stored):
    assert stored.exceptAll(lines(spark)).isEmpty() and stored.count() == lines(spark).count()
    assert warehouse.buckets("dwh", "lines") == (8, ("order_id",))


def test_totals_equal_those_of_any_table(spark, stored):
    want = totals(aggregates.totals_with_distinct, lines(spark))
    for df in (stored, lines(spark), stored.limit(0)):
        got = totals(aggregates.totals_in_buckets, df)
        assert got.schema.simpleString() == want.schema.simpleString()
        if df is not stored and df.isEmpty():
            assert got.isEmpty()
        else:
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    brute = {}
    for r in lines(spark).collect():
        orders, customers = brute.setdefault((r.who, r.month), (set(), set()))
        orders |= {r.order_id} - {None}
        customers |= {r.customer} - {None}
    got = {(r.who, r.month): (r.orders, r.customers) for r in totals(aggregates.totals_in_buckets, stored).collect()}
    assert got == {k: (len(o), len(c)) for k, (o, c) in brute.items()}


def test_counted_values_are_not_shuffled(stored):
    text = plan(totals(aggregates.totals_in_buckets, stored))
    assert "Window" in text and "Exchange" not in text[text.index("Window"):]
    assert all("_counted" not in e for e in re.findall(r"Exchange hashpartitioning\((.*?)\)", text))


def test_keys_are_checked_without_an_exchange(stored):
    grain = ["order_id", "product_id"]
    for df in (keys.duplicate_keys(stored, grain), keys.dedupe_latest(stored, grain, ["month"])):
        assert "Exchange" not in plan(df)
    checked = plan(quality.unique_checks("gold", {"lines": stored}, {"lines": grain}, "line"))
    assert re.findall(r"Exchange (\w+)", checked) == ["SinglePartition"]  # the finished counts


def test_queries_shuffle_no_orders(tables):
    for name in ("agg_employee_month_by_order", "agg_distributor_month_by_order", "dq_order_keys_by_bucket", "dedupe_in_buckets"):
        exchanges = re.findall(r"Exchange hashpartitioning\((.*?)\)", plan(QUERIES[name](tables)))
        assert not any("order_id" in e or "_counted" in e for e in exchanges), name
    assert "Exchange" not in plan(QUERIES["dedupe_in_buckets"](tables))


def test_refreshes_of_a_bucketed_table(spark, warehouse, stored):
    """The same layout is replaced by its files, another one by a new table; buckets are right after either."""
    other = lines(spark).withColumn("product_id", F.lit("p1"))
    same = warehouse.materialize(other, "dwh", "lines", buckets=Buckets(("order_id",), 8, ("month",)))
    assert same.exceptAll(other).isEmpty() and "Exchange" not in plan(keys.duplicate_keys(same, ["order_id"]))
    assert keys.duplicate_keys(same, ["order_id"]).count() == keys.duplicate_keys(other, ["order_id"]).count()
    for layout in (Buckets(("order_id",), 4), Buckets(("product_id", "who"), 4), None):
        again = warehouse.materialize(warehouse.table("dwh", "lines"), "dwh", "lines", buckets=layout)  # reads what it replaces
        assert warehouse.buckets("dwh", "lines") == (layout and (layout.count, layout.columns))
        assert again.exceptAll(other).isEmpty() and again.count() == other.count()
    assert [t.name for t in spark.catalog.listTables(warehouse.namespace("dwh"))] == ["lines"]


def test_a_failed_write_leaves_the_table(spark, warehouse, stored):
    bad = lines(spark).withColumn("amount", F.when(F.col("who") == "e3", F.raise_error(F.lit("bad amount"))).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="bad amount"):
        warehouse.materialize(bad, "dwh", "lines", buckets=Buckets(("order_id",), 8, ("month",)))
    assert warehouse.table("dwh", "lines").count() == lines(spark).count()


def test_empty_tables_have_buckets(spark, warehouse):
    empty = warehouse.materialize(lines(spark).limit(0), "dwh", "none", buckets=Buckets(("order_id",), 8))
    assert empty.isEmpty() and warehouse.buckets("dwh", "none") == (8, ("order_id",))


def test_a_build_in_order_buckets(warehouse, tables):
    for raw in ("sales_transactions", "customer_master", "product_master", "employee_master"):
        warehouse.materialize(tables[f"raw.{raw}"], "raw", raw)
    models = ["stg_sales_transactions", "stg_customers", "stg_products", "stg_employees", "dim_date", "dim_customers", "dim_products", "dim_employees", "fact_sales"]
    built = build(warehouse, models, order_buckets=4)
    for name in ("stg_sales_transactions", "fact_sales"):
        assert built[name].exceptAll(tables[name]).isEmpty() and built[name].count() == tables[name].count()
        assert "Exchange" not in plan(keys.duplicate_keys(built[name], ["order_id", "product_id"]))
    assert warehouse.buckets("dwh", "dim_customers") is None and order_layout("dim_customers", 4) is None
