"""Stored key maps, and distinct counts from bitmaps."""

import re

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import aggregates
from tradeloom.operators.bitmaps import activity, roll_up
from tradeloom.plans import gold
from tradeloom.sources.keymap import KeyMaps


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def regions(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "region string")


class TestKeyMaps:
    def test_old_members_keep_their_keys(self, spark, warehouse):
        maps = KeyMaps(warehouse)
        build = lambda *names: rows(maps.extend("regions", regions(spark, *names), ["region"], "region_key"))
        assert build("M", "Z") == [(1, "M"), (2, "Z")]
        assert build("M", "Z") == [(1, "M"), (2, "Z")]
        assert build("A", "M", "Z", "B") == [(1, "M"), (2, "Z"), (3, "A"), (4, "B")]
        # A member that is gone is not returned, but its number stays its own.
        assert build("A", "C") == [(3, "A"), (5, "C")]
        assert build("M", "C") == [(1, "M"), (5, "C")]
        assert warehouse.table("dwh", "key_regions").count() == 5

    def test_first_build_is_a_plain_surrogate(self, spark, warehouse):
        assert rows(KeyMaps(warehouse).extend("none", regions(spark), ["region"], "k")) == []
        members = spark.createDataFrame([(f"p{i % 7}", f"c{i}") for i in range(40)], "province string, channel string")
        keyed = rows(KeyMaps(warehouse).extend("pairs", members, ["province", "channel"], "k"))
        assert [r[1:] for r in sorted(keyed)] == sorted(rows(members)) and [r[0] for r in sorted(keyed)] == list(range(1, 41))

    def test_dimensions_of_a_warehouse_are_stable(self, spark, warehouse):
        class Source(dict):
            key_maps = KeyMaps(warehouse)

        def build(*pairs):
            src = Source(dim_customers=spark.createDataFrame(list(pairs), "region string, province string"))
            src["dim_regions"] = gold.dim_regions(src)
            return rows(src["dim_regions"]), rows(gold.dim_geography(src))

        build(("M", "m1"), ("Z", None))
        again = build(("A", "a1"), ("M", "m0"), ("M", "m1"), ("Z", None), (None, "x"))
        assert again[0] == [(1, "M"), (2, "Z"), (3, "A"), (4, "Unknown")]
        assert again[1] == [(1, 1, "M", "m1"), (2, 2, "Z", "Unknown"), (3, 3, "A", "a1"), (4, 1, "M", "m0"), (5, 4, "Unknown", "x")]

    def test_numbers_do_not_follow_attributes(self, spark, warehouse):
        maps = KeyMaps(warehouse)
        members = lambda *m: spark.createDataFrame(list(m), "id string, place string")
        assert rows(maps.extend_by("x", members(("b", "p"), ("a", "q")), "id", ["place"], "no")) == [("a", 2), ("b", 1)]
        assert rows(maps.extend_by("x", members(("b", "z"), ("a", "a"), ("c", "a")), "id", ["place"], "no")) == [("a", 2), ("b", 1), ("c", 3)]


class TestBitmaps:
    SCHEMA = "g string, h int, who long, what long, amount decimal(18,2)"

    def fact(self, spark, n=4000):
        # Numbers in several buckets, at their edges, missing ones, and a group without any.
        who = F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.lit(32_760) + F.col("id") % 23)
        what = F.lit(1) + (F.col("id") * 37) % 100_000
        df = spark.range(n).select(
            F.when(F.col("id") % 5 > 0, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), (F.col("id") % 3).cast("int").alias("h"),
            who.cast("long").alias("who"), what.alias("what"), (F.col("id") / 7).cast("decimal(18,2)").alias("amount"),
        )
        return df.unionByName(spark.createDataFrame([("empty", 1, None, None, None)], self.SCHEMA))

    @pytest.mark.parametrize("by", [[], ["g"], ["h"], ["g", "h"]])
    def test_counts_equal_count_distinct(self, spark, by):
        fact = self.fact(spark)
        mart = activity(fact, {"g": F.col("g"), "h": F.col("h")}, {"whos": "who", "whats": "what"}, {"total": "amount"})
        got = roll_up(mart, by, {"whos": "n_who", "whats": "n_what"}, ["total"])
        want = fact.groupBy(*by).agg(F.count_distinct("who").alias("n_who"), F.count_distinct("what").alias("n_what"), F.sum("amount").alias("total"))
        assert got.columns == want.columns and rows(got) == rows(want)

    def test_no_rows(self, spark):
        none = activity(spark.createDataFrame([], self.SCHEMA), {"g": F.col("g")}, {"whos": "who"}, {"total": "amount"})
        assert none.count() == 0
        assert rows(roll_up(none, [], {"whos": "n"}, ["total"])) == [(0, None)]


def scans(df, column):
    """How many scans of a plan read a column."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", df._jdf.queryExecution().explainString(mode)))


class TestOneScan:
    def test_marts_scan_their_fact_once(self, tables):
        for name, column in (("mart_sales_activity", "net_amount"), ("mart_sales_vs_target", "net_amount"), ("mart_distributor_performance", "qty_ordered")):
            tables[name]  # its inputs are stored
            assert scans(tables.plan(name), column) == 1, name

    def test_active_customers_leave_the_fact_alone(self, tables):
        from tradeloom.plans.measures import active_customers, sales_activity

        found = sales_activity(tables["mart_sales_activity"], ["region"])
        assert scans(found, "customer_id") == 0 and scans(found, "bits") == 1
        assert rows(found.select("region", "active_customers")) == rows(active_customers(tables["fact_sales"], ["region"]))

    def test_groups_of_null_columns_and_keys(self, spark):
        df = spark.createDataFrame([(None, "o1", "a", 1, True), (None, "o1", "b", 2, None), (None, None, "a", 3, False), ("g", "o1", None, None, True)], "g string, o string, a string, x int, f boolean")
        got = aggregates.totals_with_distinct(df, {"g": F.col("g")}, ("o", "orders"), ("a", "others"), {"x_sum": "x"}, {"fs": F.col("f"), "n": F.lit(True)})
        assert rows(got) == [("g", 1, 0, None, 1, 1), (None, 1, 2, 6, 1, 3)]
