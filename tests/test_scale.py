"""What keeps the order tables' builds in proportion to their rows."""

import re

import pytest
from pyspark.sql import functions as F

from tradeloom import functions as X
from tradeloom.operators.columns import LINEAGE
from tradeloom.plans.silver import CONVERT, SPECS, valid_keys
from tradeloom.sources.readers import read_delimited
from tradeloom.workload import queries

JIT_BYTES = 8_000


def method_sizes(df, capsys):
    """Bytes of the largest generated method of each stage."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        capsys.readouterr()
        df.select("*").explain("codegen")
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(SPECS))
def test_silver_projections_are_compiled_by_the_jvm(spark, capsys, tmp_path, name):
    """The JVM interprets methods beyond 8,000 bytes for ever, several times slower."""
    spec = SPECS[name]
    cells = {spec.renamed.get(c, c): "string" for c in spec.columns} | {c: "string" for c in LINEAGE} | {"_ingested_at": "timestamp_ntz"}
    path = str(tmp_path / "raw")
    spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in cells.items())).write.parquet(path)
    typed = valid_keys(spark.read.parquet(path), spec.required).select(
        *[CONVERT[kind](F.col(spec.renamed.get(c, c)), False).alias(c) for c, kind in spec.columns.items()], *LINEAGE
    )
    sizes = method_sizes(typed, capsys)
    assert sizes and max(sizes) <= JIT_BYTES


@pytest.mark.parametrize("cell, expected", [
    ("1", "1.0000"), (" 2.25 ", "2.2500"), ("-5.", "-5.0000"), ("+.5", "0.5000"), ("1.23450", "1.2345"), ("1.234500000000", "1.2345"),
    ("1e3", "1000.0000"), ("12.5E1", "125.0000"), ("5e-4", "0.0005"), ("0e-9", "0.0000"), ("\t3.5\n", "3.5000"), ("99999999999999", "99999999999999.0000"),
    ("1.23456", None), ("1e-5", None), ("-.00001", None), ("12e-18", None), ("999999999999999", None), ("abc", None), ("1.2.3", None),
    (" NaN ", None), ("None", None), ("NULL", None), ("", None), ("  ", None), (None, None),
])
def test_numbers_of_any_spelling(spark, cell, expected):
    df = spark.createDataFrame([(cell,)], "c string")
    got = df.select(X.to_num("c", True).cast("string")).first()[0]
    assert got == expected
    missing = cell is None or cell.strip().lower() in ("nan", "none", "null", "")
    if expected is None and not missing:
        lost = "more than four decimals" if re.search(r"\d{5}$|e-", cell) and "." in cell + "." and cell != "999999999999999" else "cast|represented|malformed"
        with pytest.raises(Exception, match=lost):
            df.select(X.to_num("c")).collect()


def test_landed_text_is_compressed_in_files_for_a_task_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "CSV_ROWS", 1_000)
    cells = spark.range(0, 3_500, 1, 1).selectExpr("cast(id as string) as a", "concat(' \"x\", ', id % 7, ' ') as b", "if(id % 3 = 0, null, 'word') as c")
    path = str(tmp_path / "landed.csv")
    queries.write_csv(cells, path)
    files = sorted(f.name for f in (tmp_path / "landed.csv").glob("part-*"))
    assert len(files) == 4 and all(f.endswith(".csv.gz") for f in files)
    back = read_delimited(spark, path)
    assert back.exceptAll(cells).isEmpty() and back.count() == 3_500


def test_a_fact_goes_to_its_buckets_from_its_model(spark):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    stored = cat.bucketed("fact_distributor_orders")
    assert "fact_distributor_orders" not in cat._stored
    rows = cat.plan("fact_distributor_orders")
    assert stored.count() == rows.count() and stored.exceptAll(rows).isEmpty()


@pytest.mark.parametrize("source", ["sales_transactions", "distributor_orders", "return_transactions"])
def test_customers_are_joined_to_orders_not_to_lines(spark, source):
    """Where customers are too many to broadcast, the exchange by customer moves orders alone."""
    bindings = queries.Bindings(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = bindings.sources()[f"raw.{source}"]()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = re.findall(r"Exchange hashpartitioning\(o_custkey#[^\n]*\n(.*?FileScan)", text, re.DOTALL)
    assert moved and not any("l_orderkey" in rows for rows in moved)


def test_the_calendar_needs_no_source(spark, tables):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    assert cat["dim_date"].exceptAll(tables["dim_date"]).isEmpty() and cat["dim_date"].count() == 1826
    assert set(cat._stored) == {"dim_date"}


def test_an_input_that_is_read_once_is_not_stored(spark, tables):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    numbers = queries.QUERIES["key_customers"](cat)
    assert numbers.exceptAll(tables["key_customers"]).isEmpty() and numbers.count() == tables["key_customers"].count()
    queries.QUERIES["dq_missing_keys"](cat)
    assert not [name for name in cat._stored if name.startswith("raw.") and name != "raw.sales_targets_raw"]
    assert not {"fact_sales", "fact_returns", "fact_distributor_orders"} & set(cat._stored)
    assert {"stg_sales_transactions", "stg_return_transactions", "stg_distributor_orders"} <= set(cat._stored)


@pytest.mark.parametrize("name", ["target_by_region", "target_by_month"])
def test_measures_of_revenue_need_no_distinct_counts(spark, name):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    found = queries.QUERIES[name](cat)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "distinct" not in plan
    assert not {"mart_sales_vs_target", "fact_sales"} & set(cat._stored)
    mart = cat["mart_sales_vs_target"]
    stored = queries.QUERIES[name](cat)
    assert found.exceptAll(stored).isEmpty() and found.count() == stored.count() and mart.where("total_orders > 0").count()


def test_an_input_that_is_stored_is_read_from_its_files(spark):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    stored = cat["fact_sales"]
    assert cat.once("fact_sales") is stored
    assert "l_orderkey" not in cat.direct("key_orders")._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["stg_sales_transactions", "stg_distributor_orders", "stg_return_transactions"])
def test_silver_straight_from_its_source_is_compiled_by_the_jvm(spark, capsys, name):
    cat = queries.BoundCatalog(spark, "/root/testdata/sf0.001")
    sizes = method_sizes(cat.direct(name), capsys)
    assert sizes and max(sizes) <= JIT_BYTES
