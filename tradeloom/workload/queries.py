"""Every registered query: operator or model over the bound tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tradeloom import functions as X
from tradeloom.operators import aggregates, columns, joins, keys, numbering, versions
from tradeloom.plans import gold, measures, quality, silver
from tradeloom.plans.catalog import Catalog, ReadOnce, SilverKeys, Straight, order_layout, refresh_silver, silver_state, write_checked
from tradeloom.plans.gold import FACT_DATES
from tradeloom.session import new_folder
from tradeloom.sources import batches, ingest, months, readers
from tradeloom.sources.buckets import Buckets
from tradeloom.sources.keymap import KeyMaps
from tradeloom.sources.specs import PROFILED, SOURCES
from tradeloom.sources.warehouse import Warehouse
from tradeloom.workload.bindings import Bindings

Query = Callable[[Catalog], DataFrame]

QUERIES: dict[str, Query] = {}
_catalogs: dict[tuple[str, str], Catalog] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class BoundCatalog(Catalog):
    """A catalog over the order-processing tables of one folder, and raw files landed from it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.bindings = Bindings(spark, folder)
        self.landing = new_folder(spark, "landing")
        self._landed: set[str] = set()
        self.ingested: Warehouse | None = None
        self.sales_months: DataFrame | None = None
        self._bucketed: dict[str, DataFrame] = {}
        super().__init__(spark, self.bindings.sources(), new_folder(spark, "tables"))

    def landed(self, name: str) -> str:
        """Path of a raw source file, written on first use."""
        path = f"{self.landing}/{name}"
        if name not in self._landed:
            LANDED[name](self, path)
            self._landed.add(name)
        return path


    def bucketed(self, name: str) -> DataFrame:
        """A table of order lines in buckets of orders, written on first use.

        A table goes from its model to its buckets, as in ``build(order_buckets=n)``: a fact is not laid out by month first, and
        Silver is not stored apart.
        """
        if name not in self._bucketed:
            warehouse, straight = new_warehouse(self), Straight(self, (*SALES, *DISTRIBUTOR_ORDERS), stored=self._bucketed)
            rows = self[name] if self.has(name) else straight.model(name)
            self._bucketed[name] = warehouse.materialize(rows, "dwh", name, buckets=order_layout(name, ORDER_BUCKETS))
        return self._bucketed[name]


# Tables of order lines up to the reader's last one, for queries that pass through them once.
SALES = ("stg_sales_transactions", "fact_sales")
RETURNS = ("stg_return_transactions", "fact_returns")
DISTRIBUTOR_ORDERS = ("stg_distributor_orders", "fact_distributor_orders", "mart_distributor_performance")

# Buckets of the order tables here: one for each 200 MB or so of the largest at the scale that is benchmarked, and then some.
ORDER_BUCKETS = 16


def catalog(spark: SparkSession, folder: str) -> BoundCatalog:
    """One catalog per application and folder, so each table is stored once."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _catalogs:
        _catalogs[key] = BoundCatalog(spark, key[1])
    return _catalogs[key]


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, which another engine prints alike."""
    exact = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, DecimalType)}
    return df.withColumns(exact) if exact else df


def registered(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: comparable(fn(catalog(spark, folder)))


def new_warehouse(cat: Catalog) -> Warehouse:
    """A warehouse of its own, as every run of a loading query starts empty."""
    warehouse = Warehouse(cat.spark, new_folder(cat.spark, "warehouse"), f"run_{uuid.uuid4().hex[:8]}_")
    warehouse.ensure_layers()
    return warehouse


def source_columns(cat: Catalog, table: str) -> DataFrame:
    """A raw source without lineage, as the file would hold it."""
    return cat[f"raw.{table}"].select(*SOURCES[table].columns)


# Rows of a landed file. Compressed text cannot be split, so that files are made for a task each.
CSV_ROWS = 500_000


def write_csv(df: DataFrame, path: str) -> None:
    """Land delimited text, compressed: it is the widest form a source has."""
    (
        df.write.option("header", True).option("escape", '"').option("compression", "gzip").option("maxRecordsPerFile", CSV_ROWS)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def write_sheets(df: DataFrame, path: str) -> None:
    df.write.partitionBy("sheet_name").parquet(path)


SALES_FILE, CUSTOMER_FILE = "SRC01_sales_transactions.csv", "SRC03_customer_master.csv"
PLAN_FILE, PRODUCT_FILE, NOTES_FILE = "SRC02_sales_target_plan.sheets", "SRC04_product_master.PARQUET", "notes.txt"

LANDED = {
    SALES_FILE: lambda cat, path: write_csv(source_columns(cat, "sales_transactions"), path),
    CUSTOMER_FILE: lambda cat, path: write_csv(source_columns(cat, "customer_master"), path),
    PLAN_FILE: lambda cat, path: write_sheets(cat.bindings.plan_sheets(), path),
    PRODUCT_FILE: lambda cat, path: source_columns(cat, "product_master").write.parquet(path),
    NOTES_FILE: lambda cat, path: cat.bindings.table("region").select("r_name").write.text(path),
}


# --- sources -----------------------------------------------------------------


@query
def src_csv_roundtrip(cat):
    return columns.missing_cells_to_null(readers.read_delimited(cat.spark, cat.landed(SALES_FILE)))


@query
def src_sheet_select(cat):
    return readers.read_sheet(cat.spark, cat.landed(PLAN_FILE), "Plan_v2_Adjustment_H2")


@query
def src_sheet_position(cat):
    """The first sheet of a source whose recorded order is not that of the names."""
    path = f"{new_folder(cat.spark, 'landing')}/{PLAN_FILE}"
    write_sheets(cat.bindings.plan_sheets(), path)
    readers.record_order(cat.spark, path, ["Plan_v2_Adjustment_H2", "summary"])
    return readers.read_source(cat.spark, path)


@query
def src_sheets_skip(cat):
    return readers.read_sheets(cat.spark, cat.landed(PLAN_FILE))


@query
def src_dispatch(cat):
    """Rows of a source in each format, the first sheet of a sheet set."""
    files = (CUSTOMER_FILE, PLAN_FILE, PRODUCT_FILE)
    return readers.row_counts({f: readers.read_source(cat.spark, cat.landed(f)) for f in files}, "source")


@query
def date_spine(cat):
    """Orders per day, days without orders included."""
    days = cat.bindings.table("orders").select(F.col("o_orderdate").cast("date").alias("d"))
    first, last = days.agg(F.min("d"), F.max("d")).first()
    spine = readers.date_spine(cat.spark, first, last)
    per_day = days.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return spine.join(per_day, spine["date_day"] == per_day["d"], "left").select(
        "date_day", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query
def bronze_row_counts(cat):
    """Each source is counted as it is made; only what decides its rows is read."""
    return readers.row_counts({t: cat.once(f"raw.{t}") for t in SOURCES})


@query
def gold_footer_counts(cat):
    """Row counts of the checked Gold tables from their files' footers."""
    return readers.footer_counts(cat.spark, {t: cat.folder_of(t) for t in quality.GOLD_COUNTED})


def _ingested(cat) -> Warehouse:
    """Sales and customers loaded once for all queries of them; the product file is missing."""
    if cat.ingested is not None:
        return cat.ingested
    warehouse = cat.ingested = new_warehouse(cat)
    paths = {
        "sales_transactions": cat.landed(SALES_FILE),
        "customer_master": cat.landed(CUSTOMER_FILE),
        "product_master": f"{cat.landing}/SRC04_product_master.csv",
    }
    ingest.ingest_all(warehouse, paths)
    return warehouse


@query
def ingest_log_latest(cat):
    log = readers.latest_ingest_log(_ingested(cat).table("raw", ingest.INGEST_LOG))
    return log.select("source_name", "source_file", "rows_loaded", "status")


@query
def ingest_log_rows(cat):
    log = _ingested(cat).table("raw", ingest.INGEST_LOG)
    return log.select(
        "source_name", "source_file", "source_platform", "rows_loaded", "status",
        F.col("error_message").isNotNull().alias("has_message"),
        (F.col("finished_at") >= F.col("started_at")).alias("finished_after_start"),
        (F.col("duration_sec") >= 0).alias("has_duration"),
        (F.length("batch_id") == 36).alias("has_batch_id"),
    )


@query
def source_inventory(cat):
    """Every landed file, one of them unreadable."""
    for name in LANDED:
        cat.landed(name)
    return readers.source_inventory(cat.spark, cat.landing).select("source_file", "status", "row_count", "columns")


@query
def bronze_load_sales(cat):
    stored = batches.committed(_ingested(cat), "sales_transactions")
    return stored.drop("_ingested_at", "_batch_id")


# --- sinks -------------------------------------------------------------------


@query
def bronze_append_twice(cat):
    """Append the same batch twice; Bronze doubles, its newest rows do not."""
    warehouse = new_warehouse(cat)
    batch = source_columns(cat, "product_master")
    for day in (1, 2):
        loaded = columns.add_lineage(batch, "SRC04", "tables", f"batch-{day}", datetime(2024, 1, day))
        warehouse.append_bronze(loaded, "product_master")
    stored = warehouse.table("raw", "product_master")
    newest = keys.dedupe_latest(stored, ["product_id"])
    return readers.row_counts({"bronze": stored, "newest": newest, "second batch": newest.where("_batch_id = 'batch-2'")})


@query
def materialize_overwrite(cat):
    """Build a table twice, the second time from itself."""
    warehouse = new_warehouse(cat)
    first = warehouse.materialize(cat["stg_products"], "staging", "stg_products")
    raised = first.withColumn("unit_price", (F.col("unit_price") * 2).cast(first.schema["unit_price"].dataType))
    second = warehouse.materialize(raised, "staging", "stg_products")
    return second.select("product_id", "category", "unit_price", "status")


@query
def replace_slice(cat):
    """Load all plan sheets, then reload one with half its rows and one as empty."""
    warehouse = new_warehouse(cat)
    slice_columns = ("_source_file", "sheet_name")
    plan = columns.normalize_plan(
        cat.bindings.plan_sheets().withColumn("sheet_name", F.regexp_replace("sheet_name", "summary", "Plan_v3_summary")),
        "SRC02", "tables", "batch-1", datetime(2024, 1, 1),
    )
    def slices(*names):
        return [{"_source_file": "SRC02", "sheet_name": n} for n in names]

    first, second, third = "Plan_v1_Original", "Plan_v2_Adjustment_H2", "Plan_v3_summary"
    warehouse.replace_slice(plan, "raw", "targets", slice_columns, slices(first, second, third))
    reload = plan.where(
        ((F.col("sheet_name") == first) & (F.col("month_col") < "T5")) | (F.col("sheet_name") == third) & F.lit(False)
    ).withColumn("_batch_id", F.lit("batch-2"))
    for _ in range(2):
        warehouse.replace_slice(reload, "raw", "targets", slice_columns, slices(first, third))
    stored = warehouse.table("raw", "targets")
    return stored.select("sheet_name", "_batch_id", "employee_id", "month_col", "target_revenue")


def _loaded_targets(cat) -> dict[str, DataFrame]:
    """Plan sheets, one with an unusable name, loaded twice."""
    sheets = cat.bindings.plan_sheets()
    draft = sheets.where("sheet_name = 'Plan_v1_Original'").withColumn("sheet_name", F.lit("Draft"))
    path = f"{new_folder(cat.spark, 'landing')}/{PLAN_FILE}"
    write_sheets(sheets.unionByName(draft), path)
    warehouse = new_warehouse(cat)
    ingest.load_target_versions(warehouse, path)
    return ingest.load_target_versions(warehouse, path)


@query
def target_sheets_aligned(cat):
    """Plan sheets of different columns: one lacks quantities, one spells its headers as a person would."""
    sheets = cat.bindings.plan_sheets()
    first = sheets.where("sheet_name = 'Plan_v1_Original'").drop("sheet_name", "target_quantity")
    second = sheets.where("sheet_name = 'Plan_v2_Adjustment_H2'").drop("sheet_name")
    second = second.toDF(*[c.replace("_", " ").title() for c in second.columns])
    path = f"{new_folder(cat.spark, 'landing')}/{PLAN_FILE}"
    first.write.parquet(f"{path}/sheet_name=Plan_v1_Original")
    second.write.parquet(f"{path}/sheet_name=Plan_v2_Adjustment_H2")
    loaded = ingest.load_target_versions(new_warehouse(cat), path)["targets"]
    return loaded.select("sheet_name", "version_label", "employee_id", "month_col", "target_revenue", "target_quantity")


def cells_of(df: DataFrame, table: str) -> DataFrame:
    """A table's rows as one text each, cells in the source's order."""
    cells = [F.coalesce(F.col(c), F.lit("<null>")) for c in SOURCES[table].columns]
    return df.select(F.lit(table).alias("table_name"), "_source_file", "_batch_id", F.concat_ws("|", *cells).alias("cells"))


@query
def bronze_load_all(cat):
    """All ten sources loaded, every stored cell."""
    warehouse, folder = new_warehouse(cat), new_folder(cat.spark, "landing")
    paths = {}
    for table, spec in SOURCES.items():
        paths[table] = f"{folder}/{spec.file}" + (".csv" if spec.sheet is None else ".sheets")
        if spec.sheet is None:
            write_csv(source_columns(cat, table), paths[table])
        else:
            write_sheets(cat.bindings.plan_sheets(), paths[table])
    ingest.ingest_all(warehouse, paths)
    stored = [cells_of(batches.committed(warehouse, t), t) for t in SOURCES]
    return quality.union_all(stored).groupBy("table_name", "_source_file", "cells").agg(F.count(F.lit(1)).alias("n"))


@query
def bronze_retry_once(cat):
    """A load lost between its rows and its audit row, run again; each row is there once.

    Two attempts get no audit row, one of the batch that is run again and one of another batch. Running the committed
    batch once more changes nothing.
    """
    warehouse, table = new_warehouse(cat), "customer_master"
    path = cat.landed(CUSTOMER_FILE)
    for batch in ("load-1", "load-0"):
        rows = ingest.to_bronze(readers.read_source(cat.spark, path), CUSTOMER_FILE, "local", batch, datetime(2024, 1, 1))
        batches.land(warehouse, rows, table, batch)
    for _ in range(2):
        ingest.ingest(warehouse, SOURCES[table], path, batch_id="load-1")
    seen = cells_of(batches.committed(warehouse, table), table)
    return seen.groupBy("table_name", "_batch_id", "cells").agg(F.count(F.lit(1)).alias("n"))


def commit(warehouse: Warehouse, df: DataFrame, table: str, batch: str) -> None:
    """Land rows as a batch with its audit row, as a load does."""
    batches.ensure_log(warehouse)
    rows = batches.land(warehouse, df, table, batch)
    warehouse.append(ingest.audit_row(warehouse.spark, table, batch, rows), "raw", batches.INGEST_LOG)


@query
def silver_incremental(cat):
    """Customers in three batches that come in mixed order, each merged on its own.

    The last to come is the oldest: its versions of known customers change nothing, its own customers are added.
    """
    warehouse, raw = new_warehouse(cat), cat["raw.customer_master"]
    second = raw.where("_batch_id = 'batch-2'")
    early = keys.valid_keys(second, ["customer_id"]).withColumn("_ingested_at", F.expr("timestamp_ntz'2023-12-31 00:00:00'"))
    early = early.withColumn("status", F.lit("Early")).unionByName(
        early.withColumn("customer_id", F.concat(F.lit("L"), F.trim("customer_id")))
    )
    for batch, rows in (("batch-2", second), ("batch-1", raw.where("_batch_id = 'batch-1'")), ("batch-0", early)):
        commit(warehouse, rows, "customer_master", batch)
        refresh_silver(warehouse, "stg_customers", parts=8)
    return silver_state(warehouse, "stg_customers").rows()


@query
def target_file_log(cat):
    return _loaded_targets(cat)["files"].select(
        "source_file", "sheet_name", "version_label", "rows_loaded", "status", "error_message"
    )


@query
def target_versions_load(cat):
    """The plan table after loading all sheets twice."""
    targets = _loaded_targets(cat)["targets"]
    return targets.select(*[c for c in columns.PLAN_COLUMNS if c not in ("_ingested_at", "_batch_id")])


@query
def target_version_summary(cat):
    return aggregates.target_version_summary(cat["raw.sales_targets_raw"])


# --- bronze transforms ---------------------------------------------------------


@query
def brz_normalize_columns(cat):
    messy = cat.bindings.table("part").select("p_partkey", "p_brand", "p_size").toDF(" Part Key ", "BRAND-Name", "Size")
    return columns.normalize_columns(messy)


@query
def brz_lineage(cat):
    orders = cat.bindings.table("orders").select("o_orderkey", "o_orderstatus")
    return columns.add_lineage(orders, "orders.csv", "tables", "batch-1", datetime(2024, 1, 1, 12, 30))


@query
def brz_all_string(cat):
    customer = cat.bindings.table("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = cat.bindings.table("orders")
    dated = orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_day"))
    joined = dated.join(customer, dated["o_custkey"] == customer["c_custkey"])
    return columns.all_string(columns.add_lineage(joined, "f", "tables", "batch-1", datetime(2024, 1, 1)))


@query
def brz_drop_empty(cat):
    """Lines reduced to sometimes empty cells."""
    cells = cat.bindings.table("lineitem").selectExpr(
        "if(l_partkey % 3 = 0, null, l_returnflag) as flag",
        "if(l_suppkey % 2 = 0, null, l_linestatus) as status",
        "if(l_orderkey % 5 = 0, l_linenumber, null) as line",
    )
    return columns.drop_empty_rows(cells).groupBy("flag", "status", "line").agg(F.count(F.lit(1)).alias("n"))


@query
def brz_align(cat):
    """A plan source without quantities and new customers."""
    short = cat.bindings.plan_sheets().drop("target_quantity", "target_new_customers")
    return columns.align(short, columns.PLAN_SHEET_COLUMNS)


@query
def brz_drop_totals(cat):
    """Orders with total words among the names."""
    rows = cat.bindings.table("orders").selectExpr(
        "cast(o_orderkey as string) as employee_id",
        "case o_custkey % 6 when 0 then 'TỔNG cộng' when 1 then 'Grand Total' when 2 then null else 'An' end as employee_name",
        "if(o_orderkey % 7 = 0, 'total', '3') as month",
    )
    return columns.drop_total_rows(rows)


@query
def brz_version_label(cat):
    sheets = cat.bindings.table("lineitem").selectExpr("concat('PLAN_V', l_linenumber, '_', l_suppkey % 4) as sheet")
    return sheets.groupBy(X.version_label("sheet").alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query
def brz_month_token(cat):
    cells = cat.bindings.table("lineitem").selectExpr(
        "case when l_partkey % 17 = 0 then 'abc' when l_partkey % 19 = 0 then null "
        "else concat(l_partkey % 15, if(l_orderkey % 2 = 0, '.7', '')) end as month"
    )
    return cells.groupBy("month", X.month_token("month").alias("token")).agg(F.count(F.lit(1)).alias("n"))


@query
def target_load_report(cat):
    return columns.target_load_report(cat["raw.sales_targets_raw"])


@query
def normalize_plan(cat):
    return cat.plan("raw.sales_targets_raw")


# --- silver expressions --------------------------------------------------------


@query
def slv_clean_text(cat):
    raw = cat["raw.customer_master"]
    return raw.select("address", *[X.clean_text(c).alias(c) for c in ("customer_id", "tax_code", "status", "region")])


@query
def slv_cast_date(cat):
    return cat["raw.sales_transactions"].select("order_id", "product_id", X.to_date_strict("order_date").alias("order_date"))


@query
def slv_cast_numeric(cat):
    raw = cat["raw.distributor_orders"]
    names = ("qty_ordered", "qty_delivered", "fill_rate_pct", "delivered_amount")
    return raw.select("order_id", "distributor_id", "product_id", *[X.to_num(c).alias(c) for c in names])


@query
def slv_cast_int(cat):
    raw = cat["raw.sales_transactions"]
    return raw.select("order_id", "product_id", *[X.to_int(c).alias(c) for c in ("order_month", "order_year")])


@query
def slv_num_to_int(cat):
    raw = cat["raw.sales_transactions"].withColumn("half", F.expr("concat(if(order_id % 2 = 0, '-', ''), product_id, '.5')"))
    return raw.select("order_id", "product_id", *[X.num_to_int(c).alias(c) for c in ("unit_price", "half")])


@query
def slv_sentinel_date(cat):
    raw = cat["raw.sales_transactions"].withColumn(
        "cell", F.expr("case order_id % 5 when 0 then ' NaT ' when 1 then 'None' when 2 then '' else order_date end")
    )
    return raw.select("order_id", "product_id", X.sentinel_date("cell").alias("day"))


@query
def slv_version_rank(cat):
    raw = cat["raw.sales_transactions"].withColumn(
        "label", F.expr("concat(element_at(array('v', 'V', 'xv', 'v-'), cast(1 + order_id % 4 as int)), order_month)")
    )
    return raw.groupBy("label", X.version_rank("label").alias("rank")).agg(F.count(F.lit(1)).alias("n"))


@query
def slv_make_date(cat):
    raw = cat["raw.sales_transactions"]
    return raw.groupBy(X.month_date(X.to_int("order_year"), X.to_int("order_month")).alias("month_date")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query
def slv_valid_keys(cat):
    valid = keys.valid_keys(cat["raw.territory_mapping"], ["territory_id", "employee_id", "customer_id"])
    return valid.select("territory_id", "employee_id", "customer_id")


@query
def slv_month_regex(cat):
    raw = cat["raw.sales_transactions"].withColumn(
        "month_col", F.expr("concat(if(order_id % 9 = 0, 't', 'T'), cast(order_month as int) + if(order_id % 4 = 0, 1, 0))")
    )
    return raw.where(X.is_month_token("month_col")).groupBy("month_col").agg(F.count(F.lit(1)).alias("n"))


# --- models --------------------------------------------------------------------


def _model(name: str) -> Query:
    return lambda cat: cat.direct(name)


for _name in silver.SILVER_MODELS:
    QUERIES["stg_targets_versioned" if _name == "stg_sales_targets_versioned" else _name] = _model(_name)
for _name in gold.GOLD_MODELS:
    if _name not in ("dim_date", "mart_sales_activity", "key_customers", "mart_sales_vs_target", "mart_distributor_performance"):
        QUERIES[_name] = _model(_name)


@query
def mart_sales_vs_target(cat):
    return Straight(cat, (*SALES, "fact_targets"), by_group=not cat.has("fact_sales")).model("mart_sales_vs_target")


@query
def mart_distributor_performance(cat):
    straight = Straight(cat, DISTRIBUTOR_ORDERS, by_group=not cat.has("fact_distributor_orders"))
    return straight.model("mart_distributor_performance")


@query
def key_customers(cat):
    return Straight(cat, SALES).model("key_customers")


@query
def mart_sales_activity(cat):
    """The activity mart, its bitmaps as the numbers of members they hold."""
    rows = cat.plan("mart_sales_activity")
    return rows.withColumn("members", F.bitmap_count("bits")).drop("bits")


@query
def dim_date(cat):
    """The calendar with the sales lines of each day."""
    lines = cat["stg_sales_transactions"].groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))
    days = cat.plan("dim_date")
    return days.join(lines, days["date_day"] == lines["order_date"], "left").select(
        *[days[c] for c in days.columns], F.coalesce("n", F.lit(0)).alias("sales_lines")
    )


# --- joins ---------------------------------------------------------------------


@query
def join_dim_lookup(cat):
    lines = cat["stg_sales_transactions"].select("order_id", "product_id", "customer_id", "quantity")
    lines = joins.lookup(lines, cat["dim_customers"], "customer_id", {"customer_key": "customer_key"})
    return joins.lookup(lines, cat["dim_products"], "product_id", {"cost_price": "cost_price"})


@query
def join_role_dates(cat):
    rows = cat["stg_distributor_orders"].select(
        "order_id", "distributor_id", "product_id", "order_date", "expected_delivery_date", "actual_delivery_date"
    )
    for role in ("order_date", "expected_delivery_date", "actual_delivery_date"):
        rows = joins.date_lookup(rows, cat["dim_date"], role, f"{role}_key")
    return rows


@query
def join_scd_asof(cat):
    lines = cat["stg_sales_transactions"].select("order_id", "product_id", "employee_id", "order_date")
    return joins.asof_scd(lines, cat["dim_employees"], "employee_id", "order_date", {"employee_key": "employee_key"})


def _event_versions(cat) -> DataFrame:
    """Each user's last event of a day, as a version valid until the next one."""
    events = cat.bindings.table("events").select("user_id", "event_id", "ts", "event_type", F.col("ts").cast("date").alias("day"))
    last = keys.dedupe_latest(events, ["user_id", "day"], ["ts", "event_id"], ties=[])
    return versions.scd2(last, "user_id", "day").select(
        "user_id", "event_type", "effective_from", "effective_to", "is_current"
    )


@query
def scd2_intervals(cat):
    return _event_versions(cat)


@query
def join_scd_asof_bucketed(cat):
    """Events with the version of their user valid a day earlier, by months of the calendar."""
    events = cat.bindings.table("events").select(
        "event_id", "user_id", F.date_sub(F.col("ts").cast("date"), 1).alias("day_before")
    )
    return joins.asof_scd(
        events, _event_versions(cat), "user_id", "day_before", {"previous_type": "event_type"}, (gold.FIRST_DAY, gold.LAST_DAY)
    )


@query
def join_scd_asof_merge(cat):
    """The same by merging dates with version starts; every ninth event has a mistyped year."""
    day_before = F.date_sub(F.col("ts").cast("date"), 1)
    mistyped = F.when(F.col("event_id") % 9 == 0, F.add_months(day_before, 12_000)).otherwise(day_before)
    events = cat.bindings.table("events").select("event_id", "user_id", mistyped.alias("day_before"))
    return joins.asof_merge(events, _event_versions(cat), "user_id", "day_before", {"previous_type": "event_type"})


@query
def join_full_outer(cat):
    """Sold and targeted revenue per employee and month, unmatched sides kept."""
    sold = Straight(cat, SALES)["stg_sales_transactions"].groupBy("employee_id", X.month_start("order_date").alias("month_date")).agg(
        F.sum("net_amount").alias("sold")
    )
    target = cat["stg_sales_targets_versioned"].where("is_latest").select(
        "employee_id", F.col("target_month_date").alias("month_date"), F.col("target_revenue").alias("target")
    )
    return joins.full_outer_coalesce(target, sold, {"employee_id": "employee_id", "month_date": "month_date"})


# --- aggregates and windows ------------------------------------------------------


@query
def agg_employee_month(cat):
    return aggregates.employee_month_actuals(Straight(cat, SALES)["fact_sales"], by_group=not cat.has("fact_sales"))


@query
def agg_distributor_month(cat):
    return aggregates.distributor_month(cat["fact_distributor_orders"], cat["dim_distributors"])


@query
def agg_employee_month_by_order(cat):
    """The actuals from the fact in buckets of orders: order ids are counted without being shuffled."""
    return aggregates.employee_month_actuals(cat.bucketed("fact_sales"), by_order=True)


@query
def agg_distributor_month_by_order(cat):
    return aggregates.distributor_month(cat.bucketed("fact_distributor_orders"), cat["dim_distributors"], by_order=True)


@query
def agg_filter_count(cat):
    flag = F.col("calculated_on_time_delivery")
    return Straight(cat, DISTRIBUTOR_ORDERS)["fact_distributor_orders"].groupBy("channel").agg(
        X.count_where(flag).alias("on_time"),
        X.count_where(~flag).alias("late"),
        X.count_where(flag.isNull()).alias("unknown"),
        X.count_where(F.col("delivery_status").isNotNull()).alias("with_status"),
    )


@query
def agg_safe_ratio(cat):
    rows = cat["stg_distributor_orders"]
    return rows.groupBy("product_id").agg(
        X.safe_ratio(F.sum("qty_delivered"), F.sum("qty_ordered")).alias("fill_rate_pct"),
        X.safe_ratio(F.sum("delivered_amount"), F.sum("gross_amount"), scale=4, pct=False).alias("delivered_ratio"),
    )


@query
def dup_keys(cat):
    return keys.duplicate_keys(cat["raw.distributor_orders"], ["order_id", "distributor_id", "product_id"])


@query
def dup_excess_rows(cat):
    return keys.excess_duplicates(cat["raw.sales_transactions"], ["order_id", "product_id"])


@query
def monthly_achievement(cat):
    return aggregates.monthly_rollup(cat["mart_sales_vs_target"], "actual_revenue", "target_revenue", "revenue_achievement_pct")


@query
def monthly_fill_rate(cat):
    return aggregates.monthly_rollup(
        cat["mart_distributor_performance"], "total_qty_delivered", "total_qty_ordered", "fill_rate_pct"
    )


@query
def distinct_unknown(cat):
    return aggregates.distinct_members(cat["dim_customers"], ["region", "province", "status"])


@query
def dedupe_latest(cat):
    raw = cat["raw.customer_master"].select("customer_id", "customer_name", "credit_limit", "_ingested_at")
    return keys.dedupe_latest(raw, ["customer_id"])


@query
def flag_latest_version(cat):
    """Latest line per part, all lines kept."""
    lines = cat.bindings.table("lineitem").selectExpr(
        "l_partkey", "cast(l_shipdate as date) as shipped", "l_orderkey", "l_linenumber", "l_suppkey"
    )
    return versions.flag_latest(lines, ["l_partkey"], ["shipped"], ["l_orderkey", "l_linenumber", "l_suppkey"])


@query
def surrogate_row_number(cat):
    members = aggregates.distinct_members(cat["raw.customer_master"], ["province", "channel", "status"])
    return numbering.surrogate(members, ["province", "channel", "status"], "member_key")


@query
def surrogate_dense_rank(cat):
    members = aggregates.distinct_members(cat["raw.customer_master"], ["province", "channel"])
    return numbering.dense_surrogate(members, "province", "province_key")


@query
def surrogate_range_partitioned(cat):
    """Products numbered in name order across partitions."""
    products = cat["stg_products"].select("product_name", "product_id")
    return numbering.surrogate(products, ["product_name", "product_id"], "product_number")


@query
def top_employees(cat):
    return measures.rank_employees(cat["mart_sales_vs_target"], "actual_revenue")


@query
def bottom_employees(cat):
    return measures.rank_employees(cat["mart_sales_vs_target"], "revenue_achievement_pct", top=False)


# --- scalar functions ----------------------------------------------------------


@query
def scalar_string(cat):
    name = F.col("c_name")
    return cat.bindings.table("customer").select(
        "c_custkey",
        F.lower(F.trim(F.concat(F.lit("  "), name, F.lit(" ")))).alias("lowered"),
        F.replace(F.lower("c_mktsegment"), F.lit("i"), F.lit("")).alias("replaced"),
        F.concat("c_mktsegment", F.lit("_"), F.nullif(F.col("c_nationkey"), F.lit(3)).cast("string")).alias("joined"),
        F.col("c_mktsegment").rlike("^(AUTO|BUILD)").alias("matched"),
        F.regexp_extract(name, r"#0*(\d+)$", 1).alias("digits"),
        name.like("%99%").alias("liked"),
        X.mentions_total(name, ("customer#0000001", "zzz")).alias("alternation"),
    )


@query
def scalar_date_parts(cat):
    day = F.col("day")
    days = cat.bindings.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return days.select(
        "o_orderkey", "day",
        F.year(day).alias("year"), F.quarter(day).alias("quarter"), F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"), X.iso_weekday(day).alias("weekday"), F.weekofyear(day).alias("week"),
        X.month_start(day).alias("month_start"), X.date_key(day).alias("date_key"),
        F.date_format(day, "MMMM").alias("month_name"), F.date_format(day, "EEEE").alias("day_name"),
        F.date_sub(day, 1).alias("day_before"), X.fiscal_year(day).alias("fiscal_year"),
        X.fiscal_quarter(day).alias("fiscal_quarter"),
    )


@query
def scalar_case_null(cat):
    balance = F.col("s_acctbal").cast("decimal(18,2)")
    missing = F.nullif(F.col("s_nationkey"), F.lit(7))
    return cat.bindings.table("supplier").select(
        "s_suppkey",
        X.tier(F.when(F.col("s_suppkey") % 9 != 0, balance), 7000, 3000).alias("tier"),
        F.coalesce(missing, F.lit(-1)).alias("nation_or_minus_one"),
        (~missing.eqNullSafe(F.lit(3))).alias("distinct_from_three"),
        missing.isNull().alias("is_missing"),
    )


@query
def scalar_math_round(cat):
    gross, discount = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    return cat.bindings.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(gross * discount, 2).alias("rebate"),
        (gross - F.round(gross * discount, 2)).alias("net"),
        X.safe_ratio(gross, F.col("l_quantity"), pct=False).alias("unit_price"),
        F.round(-gross * discount, 1).alias("negative_rounded"),
    )


# --- quality -------------------------------------------------------------------


@query
def profile_tables(cat):
    return quality.profile_tables(cat)


@query
def profile_key_nulls(cat):
    return quality.profile_all_key_nulls(ReadOnce(cat, [f"raw.{t}" for t in PROFILED]))


@query
def profile_duplicates(cat):
    return quality.profile_all_duplicates(cat)


@query
def dq_fiscal_year(cat):
    """The calendar check, and the same over the days of all sales, those outside the calendar included."""
    sales = cat["stg_sales_transactions"].select("order_date")
    calendar = F.broadcast(cat["dim_date"].select("date_day", "fiscal_year"))
    sold = sales.join(calendar, sales["order_date"] == calendar["date_day"], "left")
    own = quality.fiscal_year_check(cat)
    over_sales = quality.rule_check(
        "gold", "sales fiscal year check", sold, ~F.col("fiscal_year").eqNullSafe(X.fiscal_year(F.col("order_date")))
    )
    return own.unionByName(over_sales)


for _name, _check in {
    "dq_silver_row_counts": quality.silver_row_counts,
    "dq_silver_not_null": lambda cat: quality.silver_not_null(SilverKeys(cat)),
    "dq_silver_unique": lambda cat: quality.silver_unique(SilverKeys(cat)),
    "dq_one_latest": quality.one_latest,
    "dq_gold_row_counts": lambda cat: quality.gold_row_counts(Straight(cat, (*SALES, *RETURNS, *DISTRIBUTOR_ORDERS, "mart_sales_vs_target"))),
    "dq_dim_not_null": quality.dimension_not_null,
    "dq_dim_unique": quality.dimension_unique,
    "dq_fact_grain": lambda cat: quality.fact_grain(ReadOnce(cat, FACT_DATES)),
    "dq_missing_keys": lambda cat: quality.missing_keys(ReadOnce(cat, FACT_DATES)),
    "dq_latest_flag": quality.latest_flag_check,
    "dq_negative_target": quality.negative_target_check,
    "dq_fill_rate_bounds": lambda cat: quality.fill_rate_check(Straight(cat, DISTRIBUTOR_ORDERS)),
}.items():
    QUERIES[_name] = _check


ORDER_KEYED = ("stg_sales_transactions", "stg_distributor_orders")
ORDER_GRAINED = ("fact_sales", "fact_distributor_orders")


@query
def dq_order_keys_by_bucket(cat):
    """Key and grain checks of the order tables in buckets of orders, without an exchange of rows."""
    parts = [("silver", ORDER_KEYED, quality.SILVER_KEYS), ("gold", ORDER_GRAINED, quality.FACT_GRAINS)]
    return quality.union_all([quality.unique_checks(layer, {n: cat.bucketed(n) for n in names}, of) for layer, names, of in parts])


@query
def dedupe_in_buckets(cat):
    """Newest line of each product and order from lines that came twice, in buckets of orders."""
    if "sales twice" not in cat._bucketed:
        lines = cat["raw.sales_transactions"].select("order_id", "product_id", "order_date", "net_amount", "_ingested_at")
        layout = Buckets(("order_id",), ORDER_BUCKETS)
        cat._bucketed["sales twice"] = new_warehouse(cat).materialize(lines, "raw", "sales_transactions", buckets=layout)
    return keys.dedupe_latest(cat._bucketed["sales twice"], ["order_id", "product_id"])


@query
def dq_all(cat):
    """Every check of both layers as one report: a scan a table for its row rules, one more for each key."""
    return quality.run_checks(cat)


@query
def dq_on_write(cat):
    """The row rules of some models, counted while these are written."""
    warehouse, report = new_warehouse(cat), []
    straight = Straight(cat, (*SALES, *DISTRIBUTOR_ORDERS), by_group=not cat.has("fact_sales"))
    for name in ("stg_customers", "dim_date", "fact_targets", "fact_distributor_orders", "mart_sales_vs_target"):
        report += write_checked(warehouse, name, straight.model(name))
    return quality.report_of(cat.spark, report)


class DirtyTables(Mapping):
    """The same tables with rows that break the rules: of keys that end in 3 a second row, of those in 5 one without
    key columns. Each table is read once."""

    def __init__(self, cat: Mapping[str, DataFrame], keys_of: Mapping[str, tuple[str, ...]]):
        self._cat, self._keys = cat, keys_of

    def __getitem__(self, name: str) -> DataFrame:
        df, own = self._cat[name], self._keys.get(name)
        if not own:
            return df
        last = F.right(F.col(own[0]).cast("string"), F.lit(1))
        copies = F.when(last == "3", F.array(F.lit(0), F.lit(0))).when(last == "5", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        again = df.withColumn("_without", F.explode(copies))
        return again.withColumns({k: F.when(F.col("_without") == 0, F.col(k)) for k in own}).drop("_without")

    def __iter__(self):
        return iter(self._cat)

    def __len__(self) -> int:
        return len(self._cat)


def _dirty(check, keys_of: Mapping[str, Sequence[str]], of: Callable[[Catalog], Mapping[str, DataFrame]]) -> Query:
    own = {t: (k,) if isinstance(k, str) else tuple(k) for t, k in keys_of.items()}
    return lambda cat: check(DirtyTables(of(cat), own))


_LATEST = {"stg_sales_targets_versioned": quality.PLAN_GROUP}
for _name, _check, _keys in (
    ("dq_silver_not_null", quality.silver_not_null, quality.SILVER_REQUIRED),
    ("dq_silver_unique", quality.silver_unique, quality.SILVER_KEYS),
    ("dq_one_latest", quality.one_latest, _LATEST),
    ("dq_dim_not_null", quality.dimension_not_null, quality.DIMENSION_KEYS),
    ("dq_dim_unique", quality.dimension_unique, quality.DIMENSION_KEYS),
    ("dq_fact_grain", quality.fact_grain, quality.FACT_GRAINS),
):
    QUERIES[f"{_name}_dirty"] = _dirty(_check, _keys, SilverKeys if _name in ("dq_silver_not_null", "dq_silver_unique") else lambda cat: cat)


@query
def dq_rules_dirty(cat):
    """The row rules over tables in which rows of employees and distributors ending in 3 break them."""
    def broken(name: str, who: str, column: str, value) -> dict[str, DataFrame]:
        df = cat[name]
        bad = F.when(F.col(who).endswith("3"), F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
        return {name: df.withColumn(column, bad)}

    return quality.union_all(
        [
            quality.latest_flag_check(broken("fact_targets", "employee_id", "is_latest", False)),
            quality.negative_target_check(broken("mart_sales_vs_target", "employee_id", "target_revenue", -1)),
            quality.fill_rate_check(broken("mart_distributor_performance", "distributor_id", "fill_rate_pct", 150)),
        ]
    )


# --- measures and views ----------------------------------------------------------


@query
def kpi_sales_overview(cat):
    return measures.sales_overview(sales_and_targets(cat), ["year", "region"])


@query
def kpi_units(cat):
    return measures.units_overview(cat["mart_sales_vs_target"], ["year", "region"])


@query
def kpi_active_customers(cat):
    return measures.active_customers(cat["fact_sales"], ["order_year", "region"])


@query
def activity_by_slicer(cat):
    """Active customers and orders for each slicer of the dashboard, from the activity mart alone."""
    mart = cat["mart_sales_activity"].withColumns({"year": F.year("month_date"), "fiscal_year": X.fiscal_year(F.col("month_date"))})

    def one(name: str, rows: DataFrame, by: Sequence[str]) -> DataFrame:
        member = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in by])
        found = measures.sales_activity(rows, by)
        return found.select(F.lit(name).alias("slicer"), member.alias("member"), "active_customers", "total_orders", "revenue", "units_sold")

    slicers = [[], ["year"], ["fiscal_year"], ["region"], ["channel"], ["region", "province"], ["year", "region", "channel"], ["month_date"]]
    asia = mart.where("year = 2024 and region = 'ASIA'")
    return quality.union_all([one(",".join(by) or "all", mart, by) for by in slicers] + [one("channel of ASIA in 2024", asia, ["channel"])])


@query
def stable_member_keys(cat):
    """Keys of places after two builds, the second with members that come first in name order; old ones keep their keys."""
    maps = KeyMaps(new_warehouse(cat))
    members = aggregates.distinct_members(cat["raw.customer_master"], ["province", "channel"])
    maps.extend("places", members.where("channel > 'BUILDING'"), ["province", "channel"], "place_key")
    return maps.extend("places", members, ["province", "channel"], "place_key")


@query
def kpi_distributor(cat):
    return measures.distributor_overview(cat["mart_distributor_performance"], ["year"])


@query
def revenue_contribution(cat):
    return measures.revenue_contribution(cat["mart_distributor_performance"])


@query
def revenue_by_region(cat):
    return measures.revenue_by(cat["fact_sales"], ["region"])


@query
def revenue_by_channel(cat):
    return measures.revenue_by(cat["fact_sales"], ["channel"])


@query
def revenue_by_province(cat):
    return measures.revenue_by(cat["fact_sales"], ["region", "province"])


@query
def revenue_drilldown(cat):
    """Provinces, regions and the total of a drill-down, from one scan of the fact."""
    return measures.revenue_levels(Straight(cat, SALES)["fact_sales"])


@query
def revenue_margin_trend(cat):
    return measures.revenue_trend(cat["fact_sales"])


def sales_and_targets(cat: Catalog) -> DataFrame:
    """The mart, for measures of its revenue. Unless it is stored, it comes straight from its model and so do the sales fact and
    its Silver table: Spark then leaves out the distinct counts, and sums lines of sales as they are made."""
    return Straight(cat, (*SALES, "fact_targets", "mart_sales_vs_target"))["mart_sales_vs_target"]


@query
def target_by_month(cat):
    return measures.target_performance(sales_and_targets(cat), ["year", "month"])


@query
def target_by_region(cat):
    return measures.target_performance(sales_and_targets(cat), ["region"])


@query
def employee_detail(cat):
    return measures.employee_detail(cat["mart_sales_vs_target"])


@query
def fulfilment_by_region(cat):
    return measures.fulfilment_by(cat["mart_distributor_performance"], ["order_region"])


@query
def late_by_channel(cat):
    return measures.fulfilment_by(cat["mart_distributor_performance"], ["order_channel"])


@query
def distributor_action_priority(cat):
    return measures.distributor_priority(Straight(cat, DISTRIBUTOR_ORDERS)["mart_distributor_performance"])


@query
def slice_year(cat):
    lines = measures.year_of_sales(cat["fact_sales"], 2024)
    return measures.revenue_by(measures.slice_rows(lines, region="ASIA"), ["channel", "order_quarter"])


@query
def slice_fiscal_year(cat):
    """A fiscal year through the calendar, over the sales fact in month partitions."""
    if cat.sales_months is None:
        cat.sales_months = months.store_months(cat["fact_sales"], "order_date", new_folder(cat.spark, "sales-months"))
    lines = months.slice_by_calendar(cat.sales_months, "order_date", cat["dim_date"], ["fiscal_quarter"], fiscal_year=2023)
    return measures.revenue_by(lines, ["channel", "fiscal_quarter"])


@query
def slice_channel(cat):
    lines = measures.slice_rows(cat["fact_sales"], channel="BUILDING")
    return measures.revenue_by(lines, ["region", "order_year"])


@query
def slice_province(cat):
    lines = measures.slice_rows(cat["fact_sales"], province="CHINA")
    return measures.revenue_by(lines, ["channel", "order_year"])
