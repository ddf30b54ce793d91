"""Order-processing tables as the ten raw sources, all cells text.

Every source row is derived from table rows, so each source grows with the
tables. Order dates are moved to 2022 and later. Some keys and cells are blanked,
padded or repeated in a second batch, so that cleaning has something to do.
Nothing here is broadcast by hint.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.operators.columns import normalize_plan

# Days from 1995-01-01 to 2022-01-01.
SHIFT_DAYS = 9862
FIRST_LOAD = "timestamp_ntz'2024-01-01 00:00:00'"
PLAN_FILE = "SRC02_sales_target_plan"
PLAN_LOADED_AT = datetime(2024, 1, 1)

TABLES = "region nation customer supplier part orders lineitem events".split()

MONEY = "decimal(18,2)"


def money(sql: str) -> str:
    """A column of doubles as exact cents."""
    return f"cast({sql} as {MONEY})"


def text(sql: str) -> str:
    return f"cast({sql} as string)"


def employee(sql: str) -> str:
    return f"concat('E', lpad({sql}, 10, '0'))"


class Bindings:
    """Source-shaped DataFrames over the tables in one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sources(self) -> dict[str, Callable[[], DataFrame]]:
        return {
            "raw.sales_transactions": self.sales_transactions,
            "raw.sales_target_plan": self.sales_target_plan,
            "raw.customer_master": self.customer_master,
            "raw.product_master": self.product_master,
            "raw.distributor_orders": self.distributor_orders,
            "raw.distributor_master": self.distributor_master,
            "raw.employee_master": self.employee_master,
            "raw.territory_mapping": self.territory_mapping,
            "raw.return_transactions": self.return_transactions,
            "raw.promotion_program": self.promotion_program,
            "raw.sales_targets_raw": self.sales_targets_raw,
        }

    def _lineage(self, number: str, batch: str = "0", after: str = "0") -> list[str]:
        """Lineage columns; a later batch is loaded ``batch`` days after the first."""
        return [
            f"'SRC{number}' as _source_file",
            "'tables' as _source_platform",
            f"{FIRST_LOAD} + make_dt_interval({batch}, 0, {after}, 0) as _ingested_at",
            f"concat('batch-', {batch} + 1) as _batch_id",
        ]

    @staticmethod
    def _again(df: DataFrame, repeated: str) -> DataFrame:
        """Rows once in batch 0, and once more in batch 1 where ``repeated`` holds."""
        return df.withColumn("batch", F.expr(f"explode(if({repeated}, array(0, 1), array(0)))"))

    def _places(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "left")

    def _lines(self, orders: DataFrame | None = None, *more: dict[str, str], part: DataFrame | None = None) -> DataFrame:
        """Order lines with their order, with shifted dates. ``orders`` may bring what follows from an order's customer,
        ``part`` what follows from a line's part, ``more`` names columns that follow from a line alone.

        A part table too large to broadcast is joined before the orders: its exchange then moves the cells of a line,
        not those of its order and customer, and the amounts are computed behind it. Price and rebate follow from the
        amounts and are computed behind the exchange of lines, which moves fewer cells for it.

        Both sides grow with the data, so they are always sort-merged; this also
        spreads the lines of a file that only one task can read. What follows from
        one side is computed before the join: a date once an order, and apart from
        the cells made of it, which keeps the methods compiled from them short.
        """
        orders = (self.table("orders") if orders is None else orders).withColumn(
            "day", F.date_add(F.col("o_orderdate").cast("date"), SHIFT_DAYS)
        )
        amounts = {"gross": money("l_extendedprice"), "qty": money("l_quantity")}
        derived = {"price": f"cast(round(gross / qty, 2) as {MONEY})", "rebate": f"round(gross * {money('l_discount')}, 2)"}
        lines = self.table("lineitem")
        if part is not None:
            lines = lines.join(part, lines["l_partkey"] == part["p_partkey"], "left")
        for columns in (amounts, *more):
            lines = lines.withColumns({name: F.expr(sql) for name, sql in columns.items()})
        joined = lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"])
        return joined.withColumns({name: F.expr(sql) for name, sql in derived.items()})

    def _orders_of_customers(self) -> DataFrame:
        """Orders with customer and place, joined before the lines: a customer table too large to broadcast then costs an
        exchange of orders instead of one of lines."""
        df, customer, places = self.table("orders"), self.table("customer"), self._places()
        return df.join(customer, df["o_custkey"] == customer["c_custkey"], "left").join(
            places, customer["c_nationkey"] == places["n_nationkey"], "left"
        )

    def sales_transactions(self) -> DataFrame:
        df = self._lines(self._orders_of_customers(), part=self.table("part"))
        return df.selectExpr(
            f"{text('l_orderkey')} as order_id",
            f"{text('day')} as order_date",
            f"{text('month(day)')} as order_month",
            "concat('Q', quarter(day)) as order_quarter",
            f"{text('year(day)')} as order_year",
            f"{text('o_custkey')} as customer_id",
            "r_name as region",
            "n_name as province",
            "if(o_orderkey % 211 = 0, ' ', c_mktsegment) as channel",
            f"if(o_orderkey % 503 = 0, '', {employee('o_custkey div 20')}) as employee_id",
            f"{text('l_partkey')} as product_id",
            "p_type as product_category",
            f"{text('qty')} as quantity",
            f"{text('price')} as unit_price",
            f"{text(money('l_discount') + ' * 100')} as discount_pct",
            f"{text('rebate')} as discount_amount",
            f"{text('gross')} as gross_amount",
            f"{text('gross - rebate')} as net_amount",
            "l_linestatus as delivery_status",
            "o_orderpriority as payment_method",
            "o_orderstatus as payment_status",
            *self._lineage("01_sales_transactions", after="l_linenumber"),
        )

    def distributor_orders(self) -> DataFrame:
        part, supplier, customer = self.table("part"), self.table("supplier"), self.table("customer")
        orders, places = self.table("orders"), self._places()
        part = part.withColumn("retail", F.expr(money("p_retailprice")))
        share = "try_divide(gross * delivered, ordered)"
        rate = "try_divide(delivered * 100, ordered)"
        df = self._lines(
            orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left"),
            {"ordered": f"if(l_partkey % 211 = 0, cast(0 as {MONEY}), qty)"},
            {"delivered": f"cast(ordered - if(l_returnflag = 'R', ordered % 5, 0) as {MONEY})"},
            {
                "filled": f"cast(round({rate}, 2) as {MONEY})",
                "received": f"cast(round(coalesce({share}, 0), 2) as {MONEY})",
            },
            part=part,
        )
        df = df.join(supplier, df["l_suppkey"] == supplier["s_suppkey"], "left").join(
            places, supplier["s_nationkey"] == places["n_nationkey"], "left"
        )
        df = self._again(df, "l_orderkey % 50 = 0").withColumns(
            {
                "expected": F.expr("date_add(day, 7 + l_linenumber)"),
                "actual": F.expr(
                    "if(l_linestatus = 'O' and l_returnflag = 'N', null, date_add(day, cast(5 + l_partkey % 10 as int)))"
                ),
            }
        )
        return df.selectExpr(
            f"{text('l_orderkey')} as order_id",
            f"{text('day')} as order_date",
            f"{text('month(day)')} as order_month",
            "concat('Q', quarter(day)) as order_quarter",
            f"{text('l_suppkey')} as distributor_id",
            "r_name as region",
            "c_mktsegment as channel",
            f"{text('l_partkey')} as product_id",
            "p_type as product_category",
            f"{text('ordered')} as qty_ordered",
            f"{text('delivered')} as qty_delivered",
            f"{text('filled')} as fill_rate_pct",
            f"{text('price')} as unit_price_list",
            f"{text('retail')} as distributor_price",
            f"{text('gross')} as gross_amount",
            f"{text('received')} as delivered_amount",
            f"{text('expected')} as expected_delivery_date",
            f"{text('actual')} as actual_delivery_date",
            "l_returnflag as ontime_delivery",
            "if(l_partkey % 50 = 0, null, l_linestatus) as delivery_status",
            "if(batch = 1, 'REVISED', o_orderpriority) as payment_terms",
            *self._lineage("05_distributor_orders", batch="batch", after="l_linenumber"),
        )

    def return_transactions(self) -> DataFrame:
        lines = self._lines(self._orders_of_customers()).where("l_returnflag = 'R'")
        df = self._again(lines, "l_orderkey % 40 = 0").withColumn(
            "back", F.date_add(F.col("l_shipdate").cast("date"), SHIFT_DAYS)
        )
        return df.selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as return_id",
            f"{text('l_orderkey')} as original_order_id",
            f"{text('back')} as return_date",
            f"{text('month(back)')} as return_month",
            f"{text('o_custkey')} as customer_id",
            f"{employee('o_custkey div 20')} as employee_id",
            f"{text('l_partkey')} as product_id",
            "r_name as region",
            "n_name as province",
            f"{text('qty')} as return_quantity",
            f"{text('price')} as unit_price",
            f"{text('gross')} as return_amount",
            "if(l_linestatus = 'F', 'Damaged', 'Wrong item') as return_reason",
            "if(batch = 1, 'Closed', 'Open') as status",
            *self._lineage("09_return_transactions", batch="batch"),
        )

    def customer_master(self) -> DataFrame:
        customer, places = self.table("customer"), self._places()
        df = customer.join(places, customer["c_nationkey"] == places["n_nationkey"], "left")
        return self._again(df, "c_custkey % 10 = 0").selectExpr(
            "case when c_custkey % 97 = 0 then 'nan' when c_custkey % 89 = 0 then concat('  ', c_custkey, ' ') "
            f"else {text('c_custkey')} end as customer_id",
            "c_name as customer_name",
            "if(c_acctbal < 0, 'Retail', 'Wholesale') as customer_type",
            "c_mktsegment as channel",
            "n_name as province",
            "if(c_custkey % 101 = 0, null, r_name) as region",
            "concat('Street ', c_custkey) as address",
            "lpad(c_custkey, 10, '0') as phone",
            "if(c_custkey % 7 = 0, ' ', concat('TX', c_custkey)) as tax_code",
            "if(c_custkey % 83 = 0, '  ', 'Active') as status",
            f"{text('date_add(date ' + repr('2020-01-01') + ', cast(c_custkey % 1000 as int))')} as join_date",
            f"{text(money('c_acctbal') + ' * 25000 + batch * 1000000')} as credit_limit",
            *self._lineage("03_customer_master", batch="batch"),
        )

    def product_master(self) -> DataFrame:
        df = self._again(self.table("part"), "p_partkey % 20 = 0").withColumn("price", F.expr(money("p_retailprice")))
        return df.selectExpr(
            f"{text('p_partkey')} as product_id",
            "p_name as product_name",
            "p_type as category",
            "p_brand as sub_category",
            "'PCS' as unit",
            f"if(p_partkey % 199 = 0, '0', {text('price + batch')}) as unit_price",
            f"if(p_partkey % 97 = 0, null, {text('cast(round(price * 0.6, 2) as ' + MONEY + ')')}) as cost_price",
            f"{text('p_size * 100')} as weight_gram",
            "if(p_size > 45, 'Discontinued', 'Active') as status",
            f"{text('date_add(date ' + repr('2019-01-01') + ', cast(p_partkey % 700 as int))')} as launch_date",
            *self._lineage("04_product_master", batch="batch"),
        )

    def distributor_master(self) -> DataFrame:
        supplier, places = self.table("supplier"), self._places()
        df = supplier.join(places, supplier["s_nationkey"] == places["n_nationkey"], "left")
        return df.selectExpr(
            f"{text('s_suppkey')} as distributor_id",
            "s_name as distributor_name",
            "concat('Tier ', s_suppkey % 3 + 1) as tier",
            "if(s_suppkey % 2 = 0, 'General Trade', 'Modern Trade') as channel",
            "n_name as province",
            "r_name as region",
            "concat('Contact ', s_suppkey) as contact_person",
            "lpad(s_suppkey, 10, '0') as phone",
            "concat('d', s_suppkey, '@example.com') as email",
            "concat('TD', s_suppkey) as tax_code",
            f"{text('date_add(date ' + repr('2018-01-01') + ', cast(s_suppkey % 900 as int))')} as join_date",
            f"if(s_suppkey % 53 = 0, 'nan', {text(money('s_acctbal') + ' * 60000')}) as credit_limit",
            "if(s_suppkey % 11 = 0, '', 'Active') as status",
            f"{employee('s_suppkey div 20')} as assigned_supervisor_id",
            *self._lineage("06_distributor_master"),
        )

    def employee_master(self) -> DataFrame:
        """One employee per twenty customers, with one to three versions each; some ids are unusable."""
        ids = self.table("customer").selectExpr("c_custkey div 20 as n").distinct()
        versions = ids.withColumn(
            "v",
            F.expr("explode(filter(array(1, 2, 3), v -> v = 1 or (v = 2 and n % 2 = 0) or (v = 3 and n % 4 = 0)))"),
        )
        return versions.selectExpr(
            f"if(n % 37 = 5, 'None', {employee('n')}) as employee_id",
            "concat('Employee ', n) as full_name",
            "if(n % 2 = 0, 'F', 'M') as gender",
            f"{text('date_add(date ' + repr('1980-01-01') + ', cast(n % 7000 as int))')} as date_of_birth",
            "'2021-06-01' as join_date",
            "concat('Level ', v) as position",
            "concat('Region ', (n + v) % 5) as region",
            "concat('Team ', n % 4) as team",
            "concat('e', n, '@example.com') as email",
            "lpad(n, 10, '0') as phone",
            "if(n % 5 = 0, 'Resigned', 'Active') as status",
            "concat('v', v) as version",
            "element_at(array('2022-01-01', '2024-01-01', '2025-07-01'), v) as effective_date",
            "if(n % 5 = 0, '2026-06-30', null) as resign_date",
            "if(v > 1, 'transfer', '') as transfer_note",
            *self._lineage("07_employee_master"),
        )

    def territory_mapping(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "concat('T', lpad(c_nationkey, 2, '0')) as territory_id",
            f"{employee('c_custkey div 20')} as employee_id",
            f"if(c_custkey % 97 = 0, 'None', {text('c_custkey')}) as customer_id",
            "concat('Region ', c_nationkey % 5) as region",
            "concat('Team ', c_custkey % 4) as team",
            "'2022-01-01' as effective_date",
            "if(c_custkey % 13 = 0, '2025-12-31', null) as expiry_date",
            "'v1' as version",
            *self._lineage("08_territory_mapping"),
        )

    def promotion_program(self) -> DataFrame:
        """One promotion per five products, with a budget from their prices."""
        bundles = self.table("part").groupBy(F.expr("p_partkey div 5").alias("bundle")).agg(
            F.sum(F.expr(money("p_retailprice"))).alias("value"), F.count(F.lit(1)).alias("products"),
            F.min("p_type").alias("kind"),
        )
        return bundles.selectExpr(
            "concat('PR', bundle) as promotion_id",
            "concat('Promotion ', bundle) as promotion_name",
            "if(bundle % 2 = 0, 'Discount', 'Bundle') as promotion_type",
            "'General Trade' as target_channel",
            "'' as target_region",
            f"{text('date_add(date ' + repr('2024-01-01') + ', cast(bundle % 300 as int))')} as start_date",
            f"{text('date_add(date ' + repr('2024-02-01') + ', cast(bundle % 300 as int))')} as end_date",
            "kind as applicable_products",
            f"{text('bundle % 30')} as discount_pct",
            f"{text('products')} as min_order_quantity",
            f"{text('value')} as budget_vnd",
            f"{text('cast(round(value * 0.9, 2) as ' + MONEY + ')')} as actual_cost_vnd",
            "'Active' as status",
            "'nan' as created_by",
            *self._lineage("10_promotion_program"),
        )

    def plan_sheets(self) -> DataFrame:
        """Plan sheets with a ``sheet_name``: an original plan, a second-half revision, a summary.

        Targets come from an employee's customers, each of whom counts for one
        month. Each plan sheet also gets a blank row, two total rows and two rows
        with a bad month.
        """
        cells = (
            self.table("customer")
            .selectExpr(
                "c_custkey div 20 as n",
                "1 + c_custkey % 12 as m",
                f"{money('c_acctbal')} as balance",
            )
            .groupBy("n", "m")
            .agg(F.sum("balance").alias("balance"), F.count(F.lit(1)).alias("customers"))
        )
        sheet = F.expr(
            "explode(if(m >= 7, array('Plan_v1_Original', 'Plan_v2_Adjustment_H2', 'summary'), "
            "array('Plan_v1_Original', 'summary')))"
        )
        revised = "sheet_name = 'Plan_v2_Adjustment_H2'"
        plan = cells.withColumn("sheet_name", sheet).selectExpr(
            f"if({revised}, 'Adjustment', 'Original') as plan_version",
            f"if({revised}, '2024-06-20', '2023-12-15') as version_date",
            "'2024-01-01' as effective_from",
            "if(n % 7 = 0, 'nan', '2024-12-31') as effective_to",
            f"{employee('n')} as employee_id",
            "concat('Employee ', n) as employee_name",
            "concat('Region ', n % 5) as region",
            "concat('Team ', n % 4) as team",
            "'2024' as year",
            "if(n % 9 = 0, concat(m, '.0'), cast(m as string)) as month",
            "cast(case when n % 11 = 7 then 0 else (500000 + 10 * balance) * "
            f"if({revised}, 1.1, 1.0) end as decimal(18,3)) as revenue",
            "50 + customers as quantity",
            "customers as new_customers",
            "sheet_name",
        )
        noise = (
            self.table("region")
            .withColumn("sheet_name", F.expr("explode(array('Plan_v1_Original', 'Plan_v2_Adjustment_H2'))"))
            .selectExpr(
                "if(r_regionkey = 0, null, 'Original') as plan_version",
                *[f"cast(null as string) as {c}" for c in ("version_date", "effective_from", "effective_to")],
                "case r_regionkey when 0 then null when 1 then 'Grand Total' else 'E001' end as employee_id",
                "if(r_regionkey = 2, 'TỔNG CỘNG', null) as employee_name",
                "cast(null as string) as region",
                "cast(null as string) as team",
                "if(r_regionkey = 0, null, '2024') as year",
                "case r_regionkey when 0 then null when 3 then '13' when 4 then 'abc' else '1' end as month",
                "cast(if(r_regionkey = 0, null, 1) as decimal(18,3)) as revenue",
                "cast(null as bigint) as quantity",
                "cast(null as bigint) as new_customers",
                "sheet_name",
            )
        )
        return plan.unionByName(noise).selectExpr(
            "plan_version", "version_date", "effective_from", "effective_to", "employee_id", "employee_name",
            "region", "team", "year", "month",
            f"{text('revenue')} as target_revenue",
            f"{text('quantity')} as target_quantity",
            f"{text('new_customers')} as target_new_customers",
            "sheet_name",
        )

    def sales_target_plan(self) -> DataFrame:
        """The first sheet alone, as loaded without versions."""
        first = self.plan_sheets().where("sheet_name = 'Plan_v1_Original'").drop("sheet_name")
        return first.selectExpr("*", *self._lineage("02_sales_target_plan"))

    def sales_targets_raw(self) -> DataFrame:
        plans = self.plan_sheets().where("lower(sheet_name) <> 'summary'")
        return normalize_plan(plans, PLAN_FILE, "tables", "batch-1", PLAN_LOADED_AT)
