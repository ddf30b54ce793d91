"""The ten raw sources: Bronze table, raw file, columns, keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampNTZType, DecimalType


@dataclass(frozen=True)
class SourceSpec:
    """One logical source. ``profile_keys`` are checked for missing values,
    ``grain`` for duplicates; ``sheet`` names the sheet of a multi-sheet source;
    ``multi_line`` lets quoted cells of delimited text span lines."""

    table: str
    file: str
    columns: tuple[str, ...]
    profile_keys: tuple[str, ...]
    grain: tuple[str, ...]
    sheet: str | int | None = None
    multi_line: bool = False


def _spec(table, file, columns, profile_keys, grain, sheet=None) -> SourceSpec:
    return SourceSpec(table, file, tuple(columns.split()), tuple(profile_keys.split()), tuple(grain.split()), sheet)


# Column names, raw file names and business keys of the ten sources.
SOURCES = {
    s.table: s
    for s in (
        _spec(
            "sales_transactions", "SRC01_sales_transactions",
            "order_id order_date order_month order_quarter order_year customer_id region province channel "
            "employee_id product_id product_category quantity unit_price discount_pct discount_amount "
            "gross_amount net_amount delivery_status payment_method payment_status",
            "order_id", "order_id product_id",
        ),
        _spec(
            "sales_target_plan", "SRC02_sales_target_plan",
            "plan_version version_date effective_from effective_to employee_id employee_name region team year "
            "month target_revenue target_quantity target_new_customers",
            "plan_version employee_id month", "plan_version employee_id year month", sheet=0,
        ),
        _spec(
            "customer_master", "SRC03_customer_master",
            "customer_id customer_name customer_type channel province region address phone tax_code status "
            "join_date credit_limit",
            "customer_id", "customer_id",
        ),
        _spec(
            "product_master", "SRC04_product_master",
            "product_id product_name category sub_category unit unit_price cost_price weight_gram status launch_date",
            "product_id", "product_id",
        ),
        _spec(
            "distributor_orders", "SRC05_distributor_orders",
            "order_id order_date order_month order_quarter distributor_id region channel product_id "
            "product_category qty_ordered qty_delivered fill_rate_pct unit_price_list distributor_price "
            "gross_amount delivered_amount expected_delivery_date actual_delivery_date ontime_delivery "
            "delivery_status payment_terms",
            "order_id distributor_id product_id", "order_id distributor_id product_id",
        ),
        _spec(
            "distributor_master", "SRC06_distributor_master",
            "distributor_id distributor_name tier channel province region contact_person phone email tax_code "
            "join_date credit_limit status assigned_supervisor_id",
            "distributor_id", "distributor_id",
        ),
        _spec(
            "employee_master", "SRC07_employee_master",
            "employee_id full_name gender date_of_birth join_date position region team email phone status "
            "version effective_date resign_date transfer_note",
            "employee_id", "employee_id effective_date",
        ),
        _spec(
            "territory_mapping", "SRC08_territory_mapping",
            "territory_id employee_id customer_id region team effective_date expiry_date version",
            "territory_id employee_id customer_id", "territory_id employee_id customer_id effective_date",
        ),
        _spec(
            "return_transactions", "SRC09_return_transactions",
            "return_id original_order_id return_date return_month customer_id employee_id product_id region "
            "province return_quantity unit_price return_amount return_reason status",
            "return_id", "return_id",
        ),
        _spec(
            "promotion_program", "SRC10_promotion_program",
            "promotion_id promotion_name promotion_type target_channel target_region start_date end_date "
            "applicable_products discount_pct min_order_quantity budget_vnd actual_cost_vnd status created_by",
            "promotion_id", "promotion_id",
        ),
    )
}

# The versioned plan table is loaded from all sheets of the target plan.
TARGETS_RAW = _spec(
    "sales_targets_raw", "SRC02_sales_target_plan",
    "version_label version_date effective_from effective_to employee_id employee_name region team year month "
    "month_col target_revenue target_quantity target_new_customers sheet_name",
    "version_label employee_id month_col", "version_label employee_id year month_col",
)

PROFILED = {**SOURCES, TARGETS_RAW.table: TARGETS_RAW}


def text_schema(columns) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def bronze_schema(spec: SourceSpec) -> StructType:
    """Source columns as text, then the lineage columns."""
    return StructType(
        [StructField(c, StringType()) for c in (*spec.columns, "_source_file", "_source_platform")]
        + [StructField("_ingested_at", TimestampNTZType()), StructField("_batch_id", StringType())]
    )


INGEST_LOG_SCHEMA = StructType(
    [
        StructField("batch_id", StringType()),
        StructField("source_name", StringType()),
        StructField("source_file", StringType()),
        StructField("source_platform", StringType()),
        StructField("rows_loaded", IntegerType()),
        StructField("status", StringType()),
        StructField("error_message", StringType()),
        StructField("started_at", TimestampNTZType()),
        StructField("finished_at", TimestampNTZType()),
        StructField("duration_sec", DecimalType(12, 2)),
    ]
)

TARGET_FILES_SCHEMA = StructType(
    [
        StructField("batch_id", StringType()),
        StructField("version_label", StringType()),
        StructField("rows_loaded", IntegerType()),
        StructField("status", StringType()),
        StructField("error_message", StringType()),
        StructField("ingested_at", TimestampNTZType()),
        StructField("source_file", StringType()),
        StructField("sheet_name", StringType()),
    ]
)
