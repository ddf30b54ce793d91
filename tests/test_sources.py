"""Scans, Bronze loads, layered tables."""

import pytest
from conftest import dec
from pyspark.sql import functions as F

from tradeloom.operators.columns import LINEAGE
from tradeloom.sources import ingest, readers
from tradeloom.sources.specs import INGEST_LOG_SCHEMA, SOURCES, bronze_schema, text_schema


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


class TestReaders:
    def test_delimited_text_keeps_cells_as_written(self, spark, tmp_path):
        path = write(tmp_path / "a.csv", '﻿Order ID,Name,Price\n007,"a ""b"", c",5.0\n , NA,\n')
        df = readers.read_delimited(spark, path)
        assert df.columns == ["Order ID", "Name", "Price"]
        assert rows(df) == [(" ", " NA", None), ("007", 'a "b", c', "5.0")]

    def test_schema_must_match_the_header(self, spark, tmp_path):
        path = write(tmp_path / "a.csv", "a,b\n1,2\n")
        assert rows(readers.read_delimited(spark, path, text_schema(["a", "b"]))) == [("1", "2")]
        with pytest.raises(Exception, match="header"):
            readers.read_delimited(spark, path, text_schema(["b", "a"])).collect()

    def test_cells_over_several_lines(self, spark, tmp_path):
        path = write(tmp_path / "a.csv", 'a,b\n"x\ny",2\n')
        assert rows(readers.read_delimited(spark, path, multi_line=True)) == [("x\ny", "2")]

    def test_sheets(self, spark, tmp_path):
        root = str(tmp_path / "book.sheets")
        data = [("Plan_v1", 1), ("Plan_v2", 2), ("Summary", 3), ("Plan_v2", 4)]
        spark.createDataFrame(data, "sheet_name string, v int").write.partitionBy("sheet_name").parquet(root)
        assert rows(readers.read_sheet(spark, root, 0).select("v")) == [(1,)]
        assert rows(readers.read_sheet(spark, root, "Plan_v2").select("v")) == [(2,), (4,)]
        assert rows(readers.read_sheets(spark, root).select("v")) == [("1",), ("2",), ("4",)]
        assert rows(readers.read_source(spark, root, "Summary")) == [(3,)]

    def test_sheets_by_recorded_position(self, spark, tmp_path):
        root = str(tmp_path / "book.sheets")
        spark.createDataFrame([("A notes", 0), ("Plan", 1), ("Plan b", 2), ("Extra", 3)], "sheet_name string, v int").write.partitionBy("sheet_name").parquet(root)
        assert list(readers.sheet_folders(spark, root)) == ["A notes", "Extra", "Plan", "Plan b"]
        readers.record_order(spark, root, ["Plan b", "gone", "Plan"])
        # Those that the record does not name follow in name order.
        assert list(readers.sheet_folders(spark, root)) == ["Plan b", "Plan", "A notes", "Extra"]
        assert rows(readers.read_source(spark, root)) == [(2,)] and rows(readers.read_sheet(spark, root, 1).select("v")) == [(1,)]
        assert rows(readers.read_sheets(spark, root).select("v")) == [("0",), ("1",), ("2",), ("3",)]

    def test_sheet_choice_prunes_folders(self, spark, tmp_path):
        root = str(tmp_path / "book.sheets")
        spark.createDataFrame([("a", 1), ("b", 2)], "sheet_name string, v int").write.partitionBy("sheet_name").parquet(root)
        df = readers.read_sheet(spark, root, "b")
        assert df.inputFiles() and all("sheet_name=b" in f for f in df.inputFiles())

    @pytest.mark.parametrize("name", ["book.xlsx", "notes.txt", "noformat"])
    def test_unknown_format(self, spark, name):
        with pytest.raises(ValueError, match="unsupported source format"):
            readers.read_source(spark, f"/nowhere/{name}")

    def test_sheets_of_different_columns(self, spark, tmp_path):
        root = str(tmp_path / "book.sheets")
        for name, data, schema in (
            ("Plan v1", [("E1",)], "`Employee ID` string"), ("Plan v2", [(500, "E2")], "`Target Revenue` int, `employee-id` string"),
        ):
            spark.createDataFrame(data, schema).write.parquet(f"{root}/sheet_name={name}")
        assert rows(readers.read_sheets(spark, root).select("sheet_name", "employee_id", "target_revenue")) == [
            ("Plan v1", "E1", None), ("Plan v2", "E2", "500"),
        ]

    def test_headers_that_read_alike(self, spark, tmp_path):
        root = str(tmp_path / "book.sheets")
        spark.createDataFrame([(1, 2)], "`Target Revenue` int, target_revenue int").write.parquet(f"{root}/sheet_name=Plan_v1")
        with pytest.raises(ValueError, match="several headers read as target_revenue"):
            readers.read_sheets(spark, root)

    def test_malformed_rows(self, spark, tmp_path):
        for text in ("a,b\n1,2\n3,4,5,6\n", "a,b\n7\n", 'a,b\n"x\ny",2\n'):
            path = write(tmp_path / f"{len(text)}.csv", text)
            with pytest.raises(Exception, match="MALFORMED|malformed"):
                readers.read_delimited(spark, path).select("a").collect()
        kept = readers.read_delimited(spark, write(tmp_path / "p.csv", "a,b\n1,2\n3,4,5,6\n"), permissive=True).cache()
        assert rows(kept.where("_corrupt_record is null").select("a", "b")) == [("1", "2")]
        assert kept.where("_corrupt_record is not null").count() == 1

    def test_corrupt_source_in_an_inventory(self, spark, tmp_path):
        write(tmp_path / "a.csv", "x,y\n1,2\n")
        write(tmp_path / "c.csv", "x,y\n1,2,3\n")
        (tmp_path / "b.parquet").mkdir()
        write(tmp_path / "b.parquet" / "part.parquet", "junk")
        got = {r.source_file: r.status for r in readers.source_inventory(spark, str(tmp_path)).collect()}
        assert got == {"a.csv": "OK", "b.parquet": "FAILED", "c.csv": "FAILED"}

    def test_suffix_in_any_case(self, spark, tmp_path):
        path = write(tmp_path / "A.CSV", "a\n1\n")
        assert rows(readers.read_source(spark, path)) == [("1",)]

    def test_date_spine(self, spark):
        days = [r.date_day.isoformat() for r in readers.date_spine(spark, "2024-02-28", "2024-03-01").collect()]
        assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]
        assert readers.date_spine(spark, "2022-01-01", "2026-12-31").count() == 1826

    def test_inventory(self, spark, tmp_path):
        write(tmp_path / "a.csv", "x,y\n1,2\n3,4\n")
        write(tmp_path / "b.xlsx", "?")
        got = {r.source_file: r for r in readers.source_inventory(spark, str(tmp_path)).collect()}
        assert (got["a.csv"].status, got["a.csv"].row_count, got["a.csv"].columns) == ("OK", 2, "x, y")
        assert got["b.xlsx"].status == "FAILED" and "unsupported" in got["b.xlsx"].message

    def test_row_counts_and_completeness(self, spark):
        counts = readers.row_counts({"a": spark.range(3), "b": spark.range(0)})
        assert rows(counts) == [("a", 3), ("b", 0)]


class TestWarehouse:
    def test_namespaces(self, warehouse):
        listed = {r[0] for r in warehouse.ensure_layers().collect()}
        assert listed == {warehouse.namespace(n) for n in ("raw", "staging", "dwh")}
        with pytest.raises(ValueError, match="unknown layer"):
            warehouse.namespace("gold")

    def test_ensure_table_keeps_what_is_there(self, spark, warehouse):
        warehouse.ensure_table("raw", "log", INGEST_LOG_SCHEMA)
        assert warehouse.table("raw", "log").schema == INGEST_LOG_SCHEMA
        row = ("b", "n", "f", "p", 1, "SUCCESS", None, None, None, dec("0.5"))
        assert warehouse.append(spark.createDataFrame([row], INGEST_LOG_SCHEMA), "raw", "log") == 1
        warehouse.ensure_table("raw", "log", INGEST_LOG_SCHEMA)
        assert warehouse.table("raw", "log").count() == 1

    def test_append_bronze_is_text_and_counts(self, spark, warehouse):
        df = spark.createDataFrame([(1, 2.5), (2, None)], "`Order ID` int, `Unit-Price` double")
        assert warehouse.append_bronze(df, "t") == 2
        assert warehouse.append_bronze(df.where("`Order ID` > 5"), "t") == 0
        assert warehouse.append_bronze(df, "t") == 2
        stored = warehouse.table("raw", "t")
        assert dict(stored.dtypes) == {"order_id": "string", "unit_price": "string"}
        assert rows(stored.distinct()) == [("1", "2.5"), ("2", None)] and stored.count() == 4

    def test_materialize_may_read_itself(self, spark, warehouse):
        t = warehouse.materialize(spark.range(10), "dwh", "n")
        t = warehouse.materialize(t.where("id > 6"), "dwh", "n")
        assert rows(t) == [(7,), (8,), (9,)]
        t = warehouse.materialize(spark.createDataFrame([("x",)], "name string"), "dwh", "n")
        assert rows(t) == [("x",)] and rows(warehouse.table("dwh", "n")) == [("x",)]

    def test_versions_stay_below_the_root(self, spark, warehouse, tmp_path):
        import os

        for n in range(4):
            warehouse.materialize(spark.range(n), "dwh", "n")
            at = warehouse.location("dwh", "n").removeprefix("file:")
            assert at.startswith(warehouse.root)
            assert len(os.listdir(os.path.dirname(at))) == min(n + 1, 2)

    def test_failed_refresh_keeps_the_old_table(self, spark, warehouse):
        warehouse.materialize(spark.range(3), "dwh", "n")
        with pytest.raises(Exception):
            warehouse.materialize(spark.range(3).select((F.col("id") / F.lit(0)).cast("long").alias("id")), "dwh", "n")
        assert warehouse.table("dwh", "n").count() == 3

    def test_layout_by_month_keeps_rows(self, spark, warehouse):
        df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, date_add(date '2024-01-01', cast(id % 400 as int))) as d")
        t = warehouse.materialize(df, "dwh", "f", date="d")
        assert t.columns == ["id", "d"] and rows(t) == rows(df)

    def test_replace_slice(self, spark, warehouse):
        keys = ("file", "sheet")
        def load(data, *sheets):
            df = spark.createDataFrame(data, "v int, file string, sheet string")
            return warehouse.replace_slice(df, "raw", "t", keys, [{"file": "f", "sheet": s} for s in sheets])

        assert load([(1, "f", "a"), (2, "f", "b")], "a", "b") == [1, 1]
        for stray in ((9, "other", "a"), (9, "f", None)):
            with pytest.raises(ValueError, match="outside the slices"):
                load([(1, "f", "a"), stray], "a")
        assert load([]) == []
        assert load([(3, "f", "a"), (4, "f", "a")], "a") == [2]
        assert load([(3, "f", "a"), (4, "f", "a")], "a") == [2]  # again: no growth
        stored = lambda: rows(warehouse.table("raw", "t"))
        assert stored() == [(2, "f", "b"), (3, "f", "a"), (4, "f", "a")]
        assert load([], "a") == [0]  # came back empty: gone, the other slice stays
        assert stored() == [(2, "f", "b")]
        assert load([(5, "f", "it's")], "it's") == [1]
        assert load([], "it's") == [0]
        assert stored() == [(2, "f", "b")]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        # Replaced versions go when asked for; what is left of the table stays.
        assert warehouse.remove_unreferenced("raw", "t") > 0 and warehouse.remove_unreferenced("raw", "t") == 0
        assert stored() == [(2, "f", "b")]
        assert load([(6, "f", "a=1/2 %"), (7, "f", "b")], "a=1/2 %", "b") == [1, 1]
        assert stored() == [(6, "f", "a=1/2 %"), (7, "f", "b")]

    def test_slices_compute_their_input_once_and_publish_it_whole(self, spark, warehouse):
        tasks = spark.sparkContext.accumulator(0)

        def counted(batches):
            tasks.add(1)
            yield from batches

        first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, sheet string").coalesce(1)
        slices = [{"sheet": "a"}, {"sheet": "b"}]
        warehouse.replace_slice(first, "raw", "once", ["sheet"], slices)
        again = spark.createDataFrame([(3, "a")], "v int, sheet string").coalesce(1).mapInArrow(counted, "v int, sheet string")
        assert warehouse.replace_slice(again, "raw", "once", ["sheet"], slices) == [1, 0]
        assert tasks.value == 1
        # A failing write leaves all slices as they were.
        broken = first.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
        with pytest.raises(Exception, match="lost"):
            warehouse.replace_slice(broken, "raw", "once", ["sheet"], slices)
        assert rows(warehouse.table("raw", "once")) == [(3, "a")]


class TestIngest:
    def test_all_ten_sources(self, spark, warehouse, tmp_path):
        paths = {}
        for i, (table, spec) in enumerate(SOURCES.items()):
            # headers as a person would write them
            header = [c.replace("_", " ").title() for c in spec.columns]
            df = spark.createDataFrame([tuple(f"{c}{r}" if c != "region" else "NA" for c in spec.columns) for r in range(i + 1)], header)
            if spec.sheet is None:
                paths[table] = str(tmp_path / f"{spec.file}.csv")
                df.write.option("header", True).csv(paths[table])
            else:
                paths[table] = str(tmp_path / f"{spec.file}.sheets")
                df.withColumn("sheet_name", F.lit("first")).write.partitionBy("sheet_name").parquet(paths[table])
        assert ingest.ingest_all(warehouse, paths) == {t: "SUCCESS" for t in SOURCES}
        for i, (table, spec) in enumerate(SOURCES.items()):
            stored = warehouse.table("raw", table)
            assert set(stored.columns) == {*spec.columns, *LINEAGE}
            assert {t for c, t in stored.dtypes if c != "_ingested_at"} == {"string"}
            assert stored.count() == i + 1
            assert stored.select("_batch_id", "_ingested_at").distinct().count() == 1
            if "region" in spec.columns:
                assert stored.where("region is not null").count() == 0
        log = warehouse.table("raw", ingest.INGEST_LOG)
        assert {r.source_name: r.rows_loaded for r in log.collect()} == {t: i + 1 for i, t in enumerate(SOURCES)}

    def test_failure_is_logged_and_does_not_stop_the_rest(self, spark, warehouse, tmp_path):
        good = write(tmp_path / "good.csv", "customer_id\nC1\n")
        status = ingest.ingest_all(warehouse, {"product_master": str(tmp_path / "absent.csv"), "customer_master": good, "employee_master": "x.xlsx"})
        assert status == {"product_master": "FAILED", "customer_master": "SUCCESS", "employee_master": "FAILED"}
        log = {r.source_name: r for r in warehouse.table("raw", ingest.INGEST_LOG).collect()}
        assert (log["product_master"].rows_loaded, log["customer_master"].rows_loaded) == (0, 1)
        assert "unsupported source format" in log["employee_master"].error_message
        newest = readers.latest_ingest_log(warehouse.table("raw", ingest.INGEST_LOG), 2).collect()
        assert len(newest) == 2 and newest[0].source_name == "employee_master"

    def test_bronze_with_missing_columns_is_aligned(self, spark):
        raw = spark.createDataFrame([("C1",)], "customer_id string")
        aligned = ingest.expected_bronze(raw, SOURCES["customer_master"])
        assert set(aligned.columns) == set(SOURCES["customer_master"].columns)
        assert "_ingested_at" in bronze_schema(SOURCES["customer_master"]).names

    def test_plan_sheets(self, spark, warehouse, tmp_path):
        root = str(tmp_path / "SRC02.sheets")
        data = [("Plan_v1_A", "E1", "1"), ("Plan_v1_A", "E2", "2"), ("Plan_v2_B", "E1", "12"), ("Plan_v2_B", "Total", "12"),
                ("SUMMARY", "x", "1"), ("Draft", "E1", "1"), ("Plan_v3_C", "E1", "NA")]
        spark.createDataFrame(data, "sheet_name string, `Employee ID` string, Month string").write.partitionBy("sheet_name").parquet(root)
        for _ in range(2):
            loaded = ingest.load_target_versions(warehouse, root)
        got = rows(loaded["targets"].select("version_label", "employee_id", "month_col"))
        assert got == [("v1", "E1", "T1"), ("v1", "E2", "T2"), ("v2", "E1", "T12")]
        files = {r.sheet_name: (r.version_label, r.rows_loaded, r.status) for r in loaded["files"].collect()}
        assert files == {"Plan_v1_A": ("v1", 2, "SUCCESS"), "Plan_v2_B": ("v2", 1, "SUCCESS"), "Plan_v3_C": ("v3", 0, "SUCCESS"), "Draft": (None, 0, "FAILED")}
        assert rows(loaded["versions"].select("version_label", "row_count")) == [("v1", 2), ("v2", 1)]
        report = {(r.item, r.member): r.value for r in loaded["report"].collect()}
        assert report[("total rows", None)] == 0 and report[("rows per version", "v1")] == 2

    def test_only_skipped_sheets(self, spark, warehouse, tmp_path):
        root = str(tmp_path / "SRC02.sheets")
        spark.createDataFrame([("x",)], "month string").write.parquet(f"{root}/sheet_name=Summary")
        loaded = ingest.load_target_versions(warehouse, root)
        assert loaded["targets"].count() == loaded["files"].count() == loaded["versions"].count() == 0

    def test_a_good_sheet_loads_beside_failing_ones(self, spark, warehouse, tmp_path):
        root = str(tmp_path / "SRC02.sheets")
        schema = "`Employee ID` string, Month string"
        spark.createDataFrame([("E1", "3"), ("E2", "3.0"), ("E3", "3.7"), ("E4", "12.7")], schema).write.parquet(f"{root}/sheet_name=Plan_v1")
        spark.createDataFrame([("E1", "E1")], "`Employee ID` string, employee_id string").write.parquet(f"{root}/sheet_name=Plan_v2")
        (tmp_path / "SRC02.sheets" / "sheet_name=Plan_v3").mkdir()
        write(tmp_path / "SRC02.sheets" / "sheet_name=Plan_v3" / "part.parquet", "junk")
        loaded = ingest.load_target_versions(warehouse, root)
        files = {r.sheet_name: (r.rows_loaded, r.status) for r in loaded["files"].collect()}
        assert files == {"Plan_v1": (2, "SUCCESS"), "Plan_v2": (0, "FAILED"), "Plan_v3": (0, "FAILED")}
        assert rows(loaded["targets"].select("employee_id", "month_col")) == [("E1", "T3"), ("E2", "T3")]
