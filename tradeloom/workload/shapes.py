"""Columns, types and keys as the SQL states them, apart from the definitions the models use."""

from __future__ import annotations

from typing import NamedTuple


class Raw(NamedTuple):
    file: str
    columns: tuple[str, ...]
    profile_keys: tuple[str, ...]
    grain: tuple[str, ...]
    sheets: bool = False


class Typed(NamedTuple):
    source: str
    columns: dict[str, str]
    key: tuple[str, ...]
    required: tuple[str, ...]
    renamed: dict[str, str]


def _raw(file: str, columns: str, profile_keys: str, grain: str, sheets: bool = False) -> Raw:
    return Raw(file, tuple(columns.split()), tuple(profile_keys.split()), tuple(grain.split()), sheets)


def _typed(source: str, columns: str, key: str, required: str, **renamed: str) -> Typed:
    kinds = dict((c.split(":") + ["text"])[:2] for c in columns.split())
    return Typed(source, kinds, tuple(key.split()), tuple(required.split()), renamed)


# The raw tables.
RAW = {
    "sales_transactions": _raw(
        "SRC01_sales_transactions",
        "order_id order_date order_month order_quarter order_year customer_id region province channel "
        "employee_id product_id product_category quantity unit_price discount_pct discount_amount "
        "gross_amount net_amount delivery_status payment_method payment_status",
        "order_id", "order_id product_id",
    ),
    "sales_target_plan": _raw(
        "SRC02_sales_target_plan",
        "plan_version version_date effective_from effective_to employee_id employee_name region team year "
        "month target_revenue target_quantity target_new_customers",
        "plan_version employee_id month", "plan_version employee_id year month", True,
    ),
    "customer_master": _raw(
        "SRC03_customer_master",
        "customer_id customer_name customer_type channel province region address phone tax_code status "
        "join_date credit_limit",
        "customer_id", "customer_id",
    ),
    "product_master": _raw(
        "SRC04_product_master",
        "product_id product_name category sub_category unit unit_price cost_price weight_gram status "
        "launch_date",
        "product_id", "product_id",
    ),
    "distributor_orders": _raw(
        "SRC05_distributor_orders",
        "order_id order_date order_month order_quarter distributor_id region channel product_id "
        "product_category qty_ordered qty_delivered fill_rate_pct unit_price_list distributor_price "
        "gross_amount delivered_amount expected_delivery_date actual_delivery_date ontime_delivery "
        "delivery_status payment_terms",
        "order_id distributor_id product_id", "order_id distributor_id product_id",
    ),
    "distributor_master": _raw(
        "SRC06_distributor_master",
        "distributor_id distributor_name tier channel province region contact_person phone email tax_code "
        "join_date credit_limit status assigned_supervisor_id",
        "distributor_id", "distributor_id",
    ),
    "employee_master": _raw(
        "SRC07_employee_master",
        "employee_id full_name gender date_of_birth join_date position region team email phone status version "
        "effective_date resign_date transfer_note",
        "employee_id", "employee_id effective_date",
    ),
    "territory_mapping": _raw(
        "SRC08_territory_mapping",
        "territory_id employee_id customer_id region team effective_date expiry_date version",
        "territory_id employee_id customer_id", "territory_id employee_id customer_id effective_date",
    ),
    "return_transactions": _raw(
        "SRC09_return_transactions",
        "return_id original_order_id return_date return_month customer_id employee_id product_id region "
        "province return_quantity unit_price return_amount return_reason status",
        "return_id", "return_id",
    ),
    "promotion_program": _raw(
        "SRC10_promotion_program",
        "promotion_id promotion_name promotion_type target_channel target_region start_date end_date "
        "applicable_products discount_pct min_order_quantity budget_vnd actual_cost_vnd status created_by",
        "promotion_id", "promotion_id",
    ),
    "sales_targets_raw": _raw(
        "SRC02_sales_target_plan",
        "version_label version_date effective_from effective_to employee_id employee_name region team year "
        "month month_col target_revenue target_quantity target_new_customers sheet_name",
        "version_label employee_id month_col", "version_label employee_id year month_col",
    ),
}
TARGETS = "sales_targets_raw"
SOURCES = {t: r for t, r in RAW.items() if t != TARGETS}

# The typed tables; a column without a kind is text.
TYPED = {
    "stg_customers": _typed(
        "raw_customer_master",
        "customer_id customer_name customer_type channel province region address phone tax_code status "
        "join_date:date credit_limit:num",
        "customer_id", "customer_id",
    ),
    "stg_products": _typed(
        "raw_product_master",
        "product_id product_name category sub_category unit unit_price:num cost_price:num weight_gram:num "
        "status launch_date:date",
        "product_id", "product_id",
    ),
    "stg_employees": _typed(
        "raw_employee_master",
        "employee_id full_name gender date_of_birth:date join_date:date position region team email phone "
        "status version effective_date:date resign_date:date transfer_note",
        "employee_id effective_date", "employee_id",
    ),
    "stg_distributors": _typed(
        "raw_distributor_master",
        "distributor_id distributor_name tier channel province region contact_person phone email tax_code "
        "join_date:date credit_limit:num status assigned_supervisor_id",
        "distributor_id", "distributor_id",
    ),
    "stg_territory_mapping": _typed(
        "raw_territory_mapping",
        "territory_id employee_id customer_id region team effective_date:date expiry_date:date version",
        "territory_id employee_id customer_id effective_date", "territory_id employee_id customer_id",
    ),
    "stg_return_transactions": _typed(
        "raw_return_transactions",
        "return_id original_order_id return_date:date return_month:int customer_id employee_id product_id "
        "region province return_quantity:num unit_price:num return_amount:num return_reason status",
        "return_id", "return_id",
    ),
    "stg_promotion_program": _typed(
        "raw_promotion_program",
        "promotion_id promotion_name promotion_type target_channel target_region start_date:date "
        "end_date:date applicable_products discount_pct:num min_order_quantity:num budget_vnd:num "
        "actual_cost_vnd:num status created_by",
        "promotion_id", "promotion_id",
    ),
    "stg_sales_transactions": _typed(
        "raw_sales_transactions",
        "order_id order_date:date order_month:int order_quarter order_year:int customer_id region province "
        "channel employee_id product_id product_category quantity:num unit_price:num discount_pct:num "
        "discount_amount:num gross_amount:num net_amount:num delivery_status payment_method payment_status",
        "order_id product_id", "order_id product_id",
    ),
    "stg_distributor_orders": _typed(
        "raw_distributor_orders",
        "order_id order_date:date order_month:int order_quarter distributor_id region channel product_id "
        "product_category qty_ordered:num qty_delivered:num fill_rate_pct:num unit_price_list:num "
        "distributor_price:num gross_amount:num delivered_amount:num expected_delivery_date:date "
        "actual_delivery_date:date on_time_delivery delivery_status payment_terms",
        "order_id distributor_id product_id", "order_id distributor_id product_id", on_time_delivery="ontime_delivery",
    ),
}

# The normalised plan table.
PLAN_COLUMNS = tuple(
    ("version_label version_date effective_from effective_to employee_id employee_name region team year "
    "month month_col target_revenue target_quantity target_new_customers sheet_name _source_file "
    "_source_platform _ingested_at _batch_id").split()
)
