"""Month partitions sliced through the calendar, counts from footers."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tradeloom.plans.gold import calendar
from tradeloom.sources.months import slice_by_calendar, store_months
from tradeloom.sources.readers import footer_counts
from tradeloom.workload.queries import QUERIES


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    first = datetime.date(2022, 1, 1)
    rows = [(k, first + datetime.timedelta(days=7 * k), "r") for k in range(200)]
    rows += [(200, None, "r"), (201, datetime.date(1999, 9, 9), None), (5, rows[5][1], "r")]
    return rows, store_months(spark.createDataFrame(rows, "id int, day date, region string"), "day", str(tmp_path / "months"))


def test_slices_equal_plain_python(spark, stored):
    rows, fact = stored
    days = calendar(spark)
    assert sorted(r.id for r in fact.collect()) == sorted(k for k, _, _ in rows)
    got = slice_by_calendar(fact, "day", days, ["fiscal_quarter"], fiscal_year=2023)
    want = [k for k, d, _ in rows if d and datetime.date(2023, 9, 1) <= d < datetime.date(2024, 9, 1)]
    assert sorted(r.id for r in got.collect()) == sorted(want)
    assert got.columns == ["id", "day", "region", "month_part", "fiscal_quarter"]
    weekend = slice_by_calendar(fact, "day", days, fiscal_year=2022, is_weekend=True)
    assert sorted(r.id for r in weekend.collect()) == sorted(k for k, d, _ in rows if d and d.weekday() > 4 and datetime.date(2022, 9, 1) <= d < datetime.date(2023, 9, 1))
    assert slice_by_calendar(fact, "day", days, fiscal_year=1900).count() == 0


def test_only_the_months_of_a_slice_are_read(spark, stored, tmp_path):
    _, fact = stored
    days = str(tmp_path / "days")
    calendar(spark).write.parquet(days)
    sliced = slice_by_calendar(fact, "day", spark.read.parquet(days), fiscal_year=2023)
    plan = executed(sliced)
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan) and "BroadcastHashJoin" in plan


def test_query_prunes_by_the_calendar(tables):
    assert "dynamicpruning" in executed(QUERIES["slice_fiscal_year"](tables))


def test_odd_months(spark, stored, tmp_path):
    _, fact = stored
    with pytest.raises(ValueError, match="month_part"):
        store_months(fact, "day", str(tmp_path / "again"))
    with pytest.raises(ValueError, match="both sides"):
        slice_by_calendar(fact.withColumn("fiscal_quarter", F.lit(1)), "day", calendar(spark), ["fiscal_quarter"])
    empty = store_months(fact.drop("month_part").limit(0), "day", str(tmp_path / "none"))
    assert slice_by_calendar(empty, "day", calendar(spark), fiscal_year=2023).count() == 0


def test_counts_come_from_footers(spark, tmp_path):
    for n in (0, 7):
        spark.range(n).withColumn("x", F.lit(None).cast("string")).write.parquet(str(tmp_path / f"t{n}"))
    before = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    counts = footer_counts(spark, {f"t{n}": str(tmp_path / f"t{n}") for n in (0, 7)})
    assert {tuple(r) for r in counts.collect()} == {("t0", 0), ("t7", 7)}
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<count(*):bigint>" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == before
