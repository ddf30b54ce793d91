"""Silver and Gold models: whole-pipeline properties and rules on small fixtures."""

from datetime import datetime

import pytest
from conftest import day, dec
from pyspark.sql import functions as F

from tradeloom.functions import is_valid_key
from tradeloom.plans import gold, measures, quality, silver
from tradeloom.plans.catalog import MODELS, StoredTables, build
from tradeloom.sources.specs import SOURCES

EARLY, LATE = datetime(2024, 1, 1), datetime(2024, 1, 2)


def bronze(spark, table, *records):
    """Bronze rows from dicts; absent cells are NULL."""
    columns = [*SOURCES[table].columns, "_source_file", "_source_platform", "_ingested_at", "_batch_id"]
    data = [tuple({"_ingested_at": EARLY, **r}.get(c) for c in columns) for r in records]
    return spark.createDataFrame(data, ", ".join(f"{c} {'timestamp_ntz' if c == '_ingested_at' else 'string'}" for c in columns))


class TestSilver:
    def test_cleaned_key_is_the_key(self, spark):
        raw = bronze(
            spark, "customer_master",
            {"customer_id": "C1", "customer_name": "old"}, {"customer_id": " C1 ", "customer_name": " new ", "_ingested_at": LATE},
            {"customer_id": "nan"}, {"customer_id": None}, {"customer_id": " "},
        )
        (row,) = silver.silver(silver.SPECS["stg_customers"], raw).collect()
        assert (row.customer_id, row.customer_name) == ("C1", "new")

    def test_strict_and_permissive(self, spark):
        raw = bronze(spark, "product_master", {"product_id": "P1", "unit_price": "x", "launch_date": "2024-13-01", "cost_price": "nan", "weight_gram": "5"})
        spec = silver.SPECS["stg_products"]
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            silver.silver(spec, raw).collect()
        (row,) = silver.silver(spec, raw, permissive=True).collect()
        assert (row.unit_price, row.cost_price, row.weight_gram, row.launch_date) == (None, None, dec("5"), None)
        (rejected,) = silver.rejected_cells(spec, raw).collect()
        assert rejected.asDict() == {"unit_price": 1, "cost_price": 0, "weight_gram": 0, "launch_date": 1}

    def test_renamed_column(self, spark):
        raw = bronze(spark, "distributor_orders", {"order_id": "1", "distributor_id": "2", "product_id": "3", "ontime_delivery": "Yes"})
        (row,) = silver.silver(silver.SPECS["stg_distributor_orders"], raw).collect()
        assert row.on_time_delivery == "Yes"

    def test_every_key_part_is_required(self, spark):
        ids = {"territory_id": "T", "employee_id": "E", "customer_id": "C", "effective_date": "2024-01-01"}
        raw = bronze(spark, "territory_mapping", ids, {**ids, "employee_id": "None"}, {**ids, "effective_date": None})
        assert silver.silver(silver.SPECS["stg_territory_mapping"], raw).count() == 2

    def test_output_columns(self, tables):
        for name, spec in silver.SPECS.items():
            kinds = {"text": "string", "date": "date", "num": "decimal(18,4)", "int": "int"}
            expected = [(c, kinds[k]) for c, k in spec.columns.items()]
            assert tables[name].dtypes[: len(expected)] == expected
            assert tables[name].columns[len(expected):] == ["_source_file", "_source_platform", "_ingested_at", "_batch_id"]


@pytest.fixture(scope="module")
def days(spark):
    return {r.date_day: r for r in gold.calendar(spark).collect()}


class TestCalendar:
    def test_range(self, days):
        assert len(days) == 1826 and min(days) == day("2022-01-01") and max(days) == day("2026-12-31")

    @pytest.mark.parametrize(
        "d, expected",
        [
            ("2024-12-30", (20241230, 4, "December", 1, "Monday", 1, 2024, 2, False)),
            ("2023-10-01", (20231001, 4, "October", 7, "Sunday", 39, 2023, 1, True)),
            ("2024-08-31", (20240831, 3, "August", 6, "Saturday", 35, 2023, 4, True)),
        ],
    )
    def test_parts(self, days, d, expected):
        r = days[day(d)]
        assert (r.date_key, r.calendar_quarter, r.month_name, r.day_of_week, r.day_name, r.week_of_year, r.fiscal_year, r.fiscal_quarter, r.is_weekend) == expected


class TestProperties:
    """Over the bound tables."""

    def test_facts_keep_the_silver_rows(self, tables):
        for fact, source in {"fact_sales": "stg_sales_transactions", "fact_returns": "stg_return_transactions", "fact_distributor_orders": "stg_distributor_orders"}.items():
            assert tables[fact].count() == tables[source].count()

    def test_mart_holds_all_sales_and_all_latest_targets(self, tables):
        mart, sales, targets = tables["mart_sales_vs_target"], tables["fact_sales"], tables["fact_targets"]
        assert mart.agg(F.sum("actual_revenue"), F.sum("actual_gross_profit")).first() == sales.agg(F.sum("net_amount"), F.sum("gross_profit")).first()
        assert mart.agg(F.sum("target_revenue")).first() == targets.agg(F.sum("target_revenue")).first()

    def test_unmatched_sides(self, tables):
        mart = tables["mart_sales_vs_target"]
        no_target = mart.where("version_label is null")
        assert no_target.count() > 0
        assert no_target.where("region is not null or team is not null or target_revenue <> 0 or revenue_achievement_pct is not null").count() == 0
        no_sales = mart.where("version_label is not null and total_orders = 0")
        assert no_sales.count() > 0
        assert no_sales.where("actual_gross_profit_margin_pct is not null").count() == 0
        assert no_sales.where("target_revenue <> 0 and not (revenue_achievement_pct <=> 0.00)").count() == 0
        assert mart.where("version_label is not null and target_revenue = 0 and revenue_achievement_pct is not null").count() == 0
        assert mart.where("employee_id is null").count() > 0

    def test_intervals_of_an_employee_are_disjoint(self, tables):
        a, b = tables["dim_employees"].alias("a"), tables["dim_employees"].alias("b")
        overlap = (F.col("a.employee_id") == F.col("b.employee_id")) & (F.col("a.effective_from") < F.col("b.effective_from"))
        assert a.join(b, overlap & (F.col("a.effective_to") >= F.col("b.effective_from"))).count() == 0
        current = tables["dim_employees"].where("is_current").groupBy("employee_id").count()
        assert current.where("count <> 1").count() == 0

    def test_distributor_mart_counts(self, tables):
        mart, fact = tables["mart_distributor_performance"], tables["fact_distributor_orders"]
        m = mart.agg(F.sum("on_time_delivery_count"), F.sum("late_delivery_count"), F.sum("delivery_record_count")).first()
        f = fact.agg(F.count_if("calculated_on_time_delivery"), F.count_if(~F.col("calculated_on_time_delivery")), F.count("delivery_status")).first()
        assert tuple(m) == tuple(f)

    def test_shares(self, tables):
        shares = measures.revenue_contribution(tables["mart_distributor_performance"])
        assert abs(shares.agg(F.sum("revenue_contribution_pct")).first()[0] - 100) < dec("0.01")

    def test_region_keys_agree(self, tables):
        regions = {r.region: r.region_key for r in tables["dim_regions"].collect()}
        geography = {r.region: r.region_key for r in tables["dim_geography"].collect()}
        assert regions == geography and "Unknown" in regions and sorted(regions.values()) == list(range(1, len(regions) + 1))

    def test_slicers(self, tables):
        lines = measures.year_of_sales(tables["fact_sales"], 2024)
        assert lines.count() == measures.slice_rows(tables["fact_sales"], year=2024, year_of="order_year").count()
        asia = measures.slice_rows(lines, region="ASIA", channel="BUILDING")
        assert 0 < asia.count() < lines.count()


class TestQuality:
    def test_all_checks(self, tables):
        """31 and 33 checks; missing keys fail and nothing else: orphans are planted in the bound tables."""
        report = quality.run_checks(tables)
        assert report.columns == ["layer", "test_name", "kind", "value"]
        checks = report.collect()
        assert [sum(r.layer == layer for r in checks) for layer in ("silver", "gold")] == [31, 33]
        broken = {r.test_name for r in checks if r.kind == "failures" and r.value > 0}
        assert broken and broken <= {f"{t} missing dimension keys" for t in quality.FACT_GRAINS}

    def test_dirty_tables_are_found(self, spark):
        targets = spark.createDataFrame([(True, 5), (None, -1)], "is_latest boolean, target_revenue int")
        assert quality.latest_flag_check({"fact_targets": targets}).first().value == 1
        assert quality.negative_target_check({"mart_sales_vs_target": targets}).first().value == 1
        rates = spark.createDataFrame([(100.0,), (100.5,), (-1.0,), (None,)], "fill_rate_pct double")
        assert quality.fill_rate_check({"mart_distributor_performance": rates}).first().value == 2
        calendar = gold.calendar(spark).withColumn("fiscal_year", F.year("date_day"))
        assert quality.fiscal_year_check({"dim_date": calendar}).first().value == 1

    def test_strict_mode(self, tables):
        with pytest.raises(ValueError, match="fact_sales missing dimension keys: "):
            quality.run_checks(tables, [quality.missing_keys], strict=True)
        quality.run_checks(tables, [quality.fact_grain], strict=True)

    def test_profile_of_an_empty_table(self, spark):
        empty = spark.createDataFrame([], "id string")
        assert [tuple(r) for r in quality.profile_key_nulls(empty, ["id"]).collect()] == [("id", 0, 0, 0.0)]

    def test_profile_counts_missing_words(self, spark):
        df = spark.createDataFrame([("a",), (" NaN ",), ("",), (None,), ("b",), ("b",)], "id string")
        (row,) = quality.profile_key_nulls(df, ["id"]).collect()
        assert (row.null_count, row.null_pct) == (3, 50.0)
        assert df.where(~is_valid_key("id")).count() == 3


def test_build_in_a_warehouse(spark, warehouse, tables):
    """Bronze to marts as stored tables, equal to the models over the catalog."""
    for name in tables:
        if name.startswith("raw."):
            warehouse.materialize(tables[name], "raw", name.removeprefix("raw."))
    report = []
    stored = build(warehouse, report=report)
    # What the writes have counted is what a scan counts.
    rules = [r for t in MODELS for r in quality.row_rules(t)]
    seen = quality.report_of(warehouse.spark, report)
    assert sorted(map(tuple, seen.collect())) == sorted(map(tuple, quality.rule_report(stored, rules).collect())) and len(report) == len(rules)
    assert isinstance(stored, StoredTables) and len(stored) == len(MODELS)
    for name in ("mart_sales_vs_target", "mart_distributor_performance", "fact_returns"):
        ours, theirs = stored[name], tables[name]
        assert ours.exceptAll(theirs).count() == 0 and ours.count() == theirs.count()
    assert spark.catalog.tableExists(warehouse.name("dwh", "dim_channels"))
