"""Operators against small fixtures and brute force."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import day, dec
from pyspark.sql import functions as F

from tradeloom.operators import aggregates, columns, joins, keys, numbering, versions


def at(minute):
    return datetime(2024, 1, 1) + timedelta(minutes=minute) if minute is not None else None


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class TestKeys:
    schema = "id string, name string, _ingested_at timestamp_ntz"

    def test_newest_row_per_key(self, spark):
        df = spark.createDataFrame([("a", "old", at(1)), ("a", "new", at(2)), ("b", "only", at(0))], self.schema)
        assert rows(keys.dedupe_latest(df, ["id"]).select("id", "name")) == [("a", "new"), ("b", "only")]

    def test_missing_time_counts_as_newest(self, spark):
        df = spark.createDataFrame([("a", "timed", at(9)), ("a", "untimed", None)], self.schema)
        assert rows(keys.dedupe_latest(df, ["id"]).select("name")) == [("untimed",)]

    def test_ties_do_not_depend_on_row_order(self, spark):
        data = [("a", n, at(1)) for n in ("x", "z", "y")]
        for seed in range(4):
            random.Random(seed).shuffle(data)
            df = spark.createDataFrame(data, self.schema).repartition(seed + 1)
            assert rows(keys.dedupe_latest(df, ["id"]).select("name")) == [("z",)]

    def test_appending_a_batch_twice_changes_nothing(self, spark):
        df = spark.createDataFrame([("a", "x", at(1)), ("a", "y", at(2)), ("b", "x", at(1))], self.schema)
        assert rows(keys.dedupe_latest(df.union(df), ["id"])) == rows(keys.dedupe_latest(df, ["id"]))

    def test_duplicates(self, spark):
        df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "id string, v int")
        assert rows(keys.duplicate_keys(df, ["id", "v"])) == [("a", 1, 3), (None, 2, 2)]
        assert rows(keys.excess_duplicates(df, ["id", "v"])) == [(3,)]
        assert rows(keys.excess_duplicates(df.distinct(), ["id", "v"])) == [(0,)]

    def test_assert_pk(self, spark):
        df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
        assert keys.assert_pk(df, ["k"]) is df
        with pytest.raises(ValueError, match="1 duplicate and 0 NULL"):
            keys.assert_pk(df.union(df.where("k = 1")), ["k"])
        with pytest.raises(ValueError, match="0 duplicate and 1 NULL"):
            keys.assert_pk(df.withColumn("k", F.when(F.col("k") > 1, F.col("k"))), ["k"])


class TestLatestVersion:
    schema = "emp string, month int, label string, rank int, dated date"

    def flag(self, spark, data):
        df = spark.createDataFrame(data, self.schema)
        flagged = versions.flag_latest(df, ["emp", "month"], ["rank", "dated"], ["label"])
        return {(r.emp, r.month, r.label): r.is_latest for r in flagged.collect()}

    def test_highest_rank_wins_and_all_rows_stay(self, spark):
        got = self.flag(spark, [("e", 1, "v1", 1, None), ("e", 1, "v2", 2, None), ("e", 2, "v1", 1, None)])
        assert got == {("e", 1, "v1"): False, ("e", 1, "v2"): True, ("e", 2, "v1"): True}

    def test_missing_rank_and_date_sort_first(self, spark):
        got = self.flag(spark, [("e", 1, "v9", 9, None), ("e", 1, "draft", None, None)])
        assert got[("e", 1, "draft")]
        got = self.flag(spark, [("e", 1, "a", 2, day("2024-01-01")), ("e", 1, "b", 2, None)])
        assert got[("e", 1, "b")]

    def test_hot_group_has_one_latest(self, spark):
        data = [("hot", 1, f"v{i}", (i * 37) % 101, None) for i in range(101)] + [("e", m, "v1", 1, None) for m in range(50)]
        got = self.flag(spark, data)
        assert len(got) == 151
        assert [k for k, v in got.items() if v and k[0] == "hot"] == [("hot", 1, next(f"v{i}" for i in range(101) if (i * 37) % 101 == 100))]
        assert sum(v for k, v in got.items() if k[0] == "e") == 50


class TestEffectiveDates:
    def scd(self, spark, data):
        df = spark.createDataFrame([(e, day(f), day(t)) for e, f, t in data], "id string, d date, resigned date")
        return versions.scd2(df, "id", "d", "resigned")

    def test_intervals(self, spark):
        got = rows(
            self.scd(spark, [("a", "2022-01-01", "2023-06-30"), ("a", "2024-01-01", "2026-06-30"), ("b", "2022-01-01", None)])
            .select("id", "effective_from", "effective_to", "is_current")
        )
        assert got == sorted(
            [
                # the successor wins over the resignation
                ("a", day("2022-01-01"), day("2023-12-31"), False),
                ("a", day("2024-01-01"), day("2026-06-30"), True),
                ("b", day("2022-01-01"), day("9999-12-31"), True),
            ],
            key=repr,
        )

    def test_version_without_start_sorts_last(self, spark):
        got = {r.effective_from: r.is_current for r in self.scd(spark, [("a", "2022-01-01", None), ("a", None, None)]).collect()}
        assert got == {day("2022-01-01"): True, None: True}

    @pytest.mark.parametrize("months_of", [None, ("2022-01-01", "2026-12-31"), ("2024-03-01", "2024-03-31")])
    def test_asof_boundaries(self, spark, months_of):
        dim = self.scd(spark, [("a", "2022-01-01", None), ("a", "2024-03-15", "2025-06-30"), ("z", "2024-01-01", "2023-01-01")]).withColumn(
            "key", F.concat("id", F.lit("_"), F.date_format("effective_from", "yyyyMMdd"))
        )
        events = [
            ("a", "2021-12-31", None), ("a", "2022-01-01", "a_20220101"), ("a", "2024-03-14", "a_20220101"),
            ("a", "2024-03-15", "a_20240315"), ("a", "2025-06-30", "a_20240315"), ("a", "2025-07-01", None),
            ("z", "2024-01-01", None), ("none", "2024-01-01", None), (None, "2024-01-01", None), ("a", None, None),
        ]
        fact = spark.createDataFrame([(i, e, day(d)) for i, (e, d, _) in enumerate(events)], "i int, emp string, d date")
        fact = fact.withColumnRenamed("emp", "id")
        got = joins.asof_scd(fact, dim, "id", "d", {"key": "key"}, months_of)
        assert [r.key for r in got.orderBy("i").collect()] == [k for _, _, k in events]
        assert got.columns == ["i", "id", "d", "key"]

    def test_month_buckets_agree_with_direct_join(self, spark):
        rng = random.Random(3)
        starts = {(f"e{rng.randrange(5)}", rng.randrange(900)) for _ in range(80)}
        origin = day("2022-01-01")
        dim = versions.scd2(
            spark.createDataFrame([(e, origin + timedelta(days=n)) for e, n in starts], "id string, d date"), "id", "d"
        ).withColumn("start", F.col("effective_from"))
        fact = spark.createDataFrame(
            [(i, f"e{rng.randrange(6)}", origin + timedelta(days=rng.randrange(-50, 1200))) for i in range(400)], "i int, id string, d date"
        )
        direct = joins.asof_scd(fact, dim, "id", "d", {"start": "start"})
        bucketed = joins.asof_scd(fact, dim, "id", "d", {"start": "start"}, ("2022-01-01", "2023-06-30"))
        assert rows(direct) == rows(bucketed)
        assert direct.count() == 400

    def test_empty_fact(self, spark):
        dim = self.scd(spark, [("a", "2022-01-01", None)])
        fact = spark.createDataFrame([], "id string, d date")
        assert joins.asof_scd(fact, dim, "id", "d", {"f": "effective_from"}, ("2022-01-01", "2026-12-31")).count() == 0

    def test_far_off_date_does_not_lengthen_the_lists(self, spark):
        dim = self.scd(spark, [(f"e{n}", "2022-01-01", None) for n in range(50)])
        fact = spark.createDataFrame([("e1", day("9999-12-30")), ("e2", day("2024-05-05"))], "id string, d date")
        got = joins.asof_scd(fact, dim, "id", "d", {"f": "effective_from"}, ("2022-01-01", "2026-12-31"))
        assert rows(got) == [("e1", day("9999-12-30"), day("2022-01-01")), ("e2", day("2024-05-05"), day("2022-01-01"))]
        far = joins.asof_scd(fact.where("d > '2026-12-31'"), dim, "id", "d", {"f": "effective_from"}, ("2022-01-01", "2026-12-31"))
        assert rows(far) == [("e1", day("9999-12-30"), day("2022-01-01"))]


class TestGroupingSets:
    PLAN = "version_label string, month_col string, employee_id string, employee_name string"

    def test_load_report_tells_null_members_from_totals(self, spark):
        df = spark.createDataFrame([("v1", "T1", "E1", "a"), ("v1", None, "E2", "Tổng"), (None, "T1", None, None), ("v2", "Total", "E1", "a")], self.PLAN)
        want = [("rows per month", "T1", 2), ("rows per month", "Total", 1), ("rows per month", None, 1), ("rows per version", "v1", 2),
                ("rows per version", "v2", 1), ("rows per version", None, 1), ("total rows", None, 2)]
        assert rows(columns.target_load_report(df)) == sorted(want, key=repr)
        assert rows(columns.target_load_report(df.limit(0))) == [("total rows", None, 0)]
        assert rows(columns.target_load_report(df.where("version_label = 'v1'").limit(1)))[-1] == ("total rows", None, 0)

    def test_drill_down_levels(self, spark):
        from tradeloom.plans.measures import revenue_by, revenue_levels

        data = [("N", "a", 10, 1), ("N", None, 20, 2), (None, "a", 30, 3), (None, None, 40, 4)]
        fact = spark.createDataFrame(data, "region string, province string, net_amount int, quantity int")
        fact = fact.select("region", "province", *[F.col(c).cast("decimal(18,4)").alias(c) for c in ("net_amount", "quantity")], F.lit(1).cast("decimal(18,4)").alias("gross_profit"))
        got = revenue_levels(fact)
        for level, by in enumerate([[], ["region"], ["region", "province"]]):
            own = got.where(F.col("level") == level)
            measures = ["revenue", "gross_profit", "units_sold", "gross_profit_margin_pct"]
            assert rows(own.select(*by, *measures)) == rows(revenue_by(fact, by).select(*by, *measures))
        assert got.count() == 4 + 2 + 1


class TestAsofMerge:
    def test_equals_the_join_by_months(self, spark):
        starts = [f"2022-{m:02d}-{d:02d}" for m in range(1, 13) for d in (1, 9)]
        dim = spark.createDataFrame([(f"e{i % 5}", day(s)) for i, s in enumerate(starts)] + [("e9", day("2022-03-01"))], "id string, start date")
        dim = versions.scd2(dim, "id", "start").where("not (id = 'e3' and is_current)")
        dates = [day(f"{y}-{m:02d}-{d:02d}") for y in (1022, 2021, 2022, 2023, 3022) for m in range(1, 13) for d in (1, 8, 9, 28)]
        fact = spark.createDataFrame([(n, f"e{i}", d) for n, (i, d) in enumerate((i, d) for i in range(7) for d in dates)] + [(-1, None, dates[0]), (-2, "e1", None)], "n int, id string, d date")
        got = joins.asof_merge(fact, dim, "id", "d", {"start": "start", "now": "is_current"})
        want = joins.asof_scd(fact, dim, "id", "d", {"start": "start", "now": "is_current"}, ("2022-01-01", "2022-12-31"))
        assert got.columns == want.columns == ["n", "id", "d", "start", "now"]
        assert rows(got) == rows(want) and got.count() == fact.count()

    def test_boundaries_and_ends(self, spark):
        dim = spark.createDataFrame(
            [("a", day("2022-01-01"), day("2022-01-05"), "k1"), ("a", day("2022-01-06"), day("2022-01-10"), "k2"), ("a", day("2022-02-01"), day("2022-01-01"), "never")],
            "id string, effective_from date, effective_to date, key string",
        )
        dates = ["2021-12-31", "2022-01-01", "2022-01-05", "2022-01-06", "2022-01-10", "2022-01-11", "2022-02-02"]
        fact = spark.createDataFrame([("a", day(d)) for d in dates] * 2 + [("b", day(dates[1]))], "id string, d date")
        got = joins.asof_merge(fact, dim, "id", "d", {"k": "key"})
        keys = [None, "k1", "k1", "k2", "k2", None, None]
        assert rows(got) == sorted([("a", day(d), k) for d, k in zip(dates, keys)] * 2 + [("b", day(dates[1]), None)], key=repr)
        assert rows(joins.asof_merge(fact.limit(0), dim, "id", "d", {"k": "key"})) == []
        assert {r.k for r in joins.asof_merge(fact, dim.limit(0), "id", "d", {"k": "key"}).collect()} == {None}

    def test_100_000_versions_of_one_id(self, spark):
        first = F.lit("1800-01-01").cast("date")
        dim = spark.range(100_000).select(
            F.lit("hot").alias("id"), F.date_add(first, F.col("id").cast("int")).alias("effective_from"),
            F.date_add(first, F.col("id").cast("int")).alias("effective_to"), F.col("id").alias("n"),
        )
        fact = spark.range(300_000).select(F.lit("hot").alias("id"), F.date_add(first, (F.col("id") % 150_000 - 20_000).cast("int")).alias("d"))
        got = joins.asof_merge(fact, dim, "id", "d", {"n": "n"}).groupBy(F.col("n").isNull().alias("none")).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.datediff("d", first) == F.col("n")).alias("right")
        )
        assert {r.none: (r.rows, r.right) for r in got.collect()} == {False: (200_000, 200_000), True: (100_000, 0)}


class TestJoins:
    def test_lookup_keeps_every_fact_row(self, spark):
        fact = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "i int, id string")
        dim = spark.createDataFrame([("a", 5)], "id string, cost int")
        assert rows(joins.lookup(fact, dim, "id", {"c": "cost"})) == [(1, "a", 5), (2, "x", None), (3, None, None)]

    def test_date_roles(self, spark):
        fact = spark.createDataFrame([(day("2024-01-01"), None), (day("1999-01-01"), day("2024-01-02"))], "a date, b date")
        dim = spark.createDataFrame([(day("2024-01-01"), 20240101), (day("2024-01-02"), 20240102)], "date_day date, date_key int")
        got = joins.date_lookup(joins.date_lookup(fact, dim, "a", "a_key"), dim, "b", "b_key")
        assert rows(got.select("a_key", "b_key")) == [(20240101, None), (None, 20240102)]

    def test_full_outer_keeps_null_keys_of_both_sides(self, spark):
        left = spark.createDataFrame([("a", 1, 10), (None, 1, 11), ("l", 1, 12), ("a", None, 13)], "id string, m int, t int")
        right = spark.createDataFrame([("a", 1, 20), (None, 1, 21), ("r", 2, 22), ("a", None, 23)], "emp string, mm int, s int")
        got = joins.full_outer_coalesce(left, right, {"id": "emp", "m": "mm"}, spread=4)
        assert got.columns == ["id", "m", "t", "s"]
        assert rows(got) == sorted(
            [("a", 1, 10, 20), (None, 1, 11, None), (None, 1, None, 21), ("l", 1, 12, None), ("r", 2, None, 22), ("a", None, 13, None), ("a", None, None, 23)],
            key=repr,
        )


class TestNumbering:
    def test_contiguous_in_order(self, spark):
        df = spark.createDataFrame([(f"m{i:03d}", i % 3) for i in range(200)], "name string, v int").repartition(7)
        got = numbering.surrogate(df, ["name"], "k").orderBy("k").collect()
        assert [r.k for r in got] == list(range(1, 201))
        assert [r.name for r in got] == sorted(r.name for r in got)

    def test_dense(self, spark):
        df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 4)], "g string, v int")
        got = numbering.dense_surrogate(df, "g", "k")
        assert rows(got) == [(1, "a", 2), (2, "b", 1), (2, "b", 3), (3, "c", 4)]


class TestAggregates:
    def test_distinct_members(self, spark):
        df = spark.createDataFrame([("a",), (None,), ("a",), (None,)], "r string")
        assert rows(aggregates.distinct_members(df, ["r"])) == [("Unknown",), ("a",)]

    def test_shares_sum_to_all(self, spark):
        df = spark.createDataFrame([("a", dec("1")), ("b", dec("2")), ("c", dec("5"))], "id string, v decimal(18,4)")
        shares = {r.id: r.s for r in aggregates.share_of_total(df, "v", "s").collect()}
        assert shares == {"a": dec("12.5"), "b": dec("25"), "c": dec("62.5")}

    def test_top_and_bottom(self, spark):
        df = spark.createDataFrame([("a", 3), ("b", 1), ("c", None), ("d", 3), (None, 9)], "id string, v int")
        assert [r.id for r in aggregates.top_n(df, "v", "id", 2).collect()] == ["a", "d"]
        assert [r.id for r in aggregates.top_n(df, "v", "id", 1, top=False).collect()] == ["b"]

    def test_version_summary_orders_months_as_text(self, spark):
        data = [("v1", "f", "s", "e1", m, at(1)) for m in ("T9", "T12", "T1")] + [("v1", "f", "s", "e2", "T9", at(2))]
        df = spark.createDataFrame(data, "version_label string, _source_file string, sheet_name string, employee_id string, month_col string, _ingested_at timestamp_ntz")
        (r,) = aggregates.target_version_summary(df).collect()
        assert (r.row_count, r.employee_count, r.month_count, r.min_month_col, r.max_month_col) == (4, 2, 3, "T1", "T9")
        assert (r.first_ingested_at, r.last_ingested_at) == (at(1), at(2))


class TestColumns:
    def test_names(self):
        assert [columns.normalize_name(c) for c in (" Order ID ", "Ship-To", "a b-c")] == ["order_id", "ship_to", "a_b_c"]

    def test_align_and_empty_rows(self, spark):
        df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
        aligned = columns.align(columns.drop_empty_rows(df), ["x", "z"])
        assert aligned.columns == ["x", "y", "z"] and rows(aligned) == [("a", None, None)]

    def test_plan_sheet(self, spark):
        data = [
            ("Plan_v1_A", "E1", "An", "1", "100"), ("Plan_v1_A", "E1", "An", "13", "100"), ("Plan_v1_A", None, None, None, None),
            ("Plan_v1_A", "Total", None, "2", "5"), ("Plan_v2_B", "E2", "tổng", "2", "5"), ("Plan_v2_B", None, None, "3.0", "7"),
        ]
        df = spark.createDataFrame(data, ["sheet_name", "Employee ID", "Employee-Name", "MONTH", "target revenue"])
        plan = columns.normalize_plan(df, "f.xlsx", "local", "b", at(0))
        assert tuple(plan.columns) == columns.PLAN_COLUMNS
        assert {f.dataType.simpleString() for f in plan.schema.fields if f.name != "_ingested_at"} == {"string"}
        got = rows(plan.select("version_label", "employee_id", "month_col", "target_revenue", "target_quantity"))
        assert got == [("v1", "E1", "T1", "100", None), ("v2", None, "T3", "7", None)]

    def test_leftover_totals(self, spark):
        df = spark.createDataFrame([("E1", "An", "T1"), ("TỔNG", None, "T1"), (None, None, "Total")], "employee_id string, employee_name string, month_col string")
        assert columns.has_total_word(df).count() == 2
