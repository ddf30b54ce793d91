"""Silver models: cleaned, typed, one row per business key.

Nine models are a column list and a key; one generic builder makes them. The
plan model adds version resolution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import (
    clean_text, is_month_token, month_date, num_to_int, sentinel_date, sentinel_to_null, to_date_strict, to_int,
    to_num, version_rank,
)
from tradeloom.operators.columns import LINEAGE
from tradeloom.operators.keys import dedupe_latest, valid_keys
from tradeloom.operators.versions import flag_latest

Tables = Mapping[str, DataFrame]

CONVERT = {
    "text": lambda c, permissive: clean_text(c),
    "date": to_date_strict,
    "num": to_num,
    "int": to_int,
}


@dataclass(frozen=True)
class SilverSpec:
    """``columns`` maps output column to type, ``key`` is unique in the result,
    ``required`` are the key columns that must hold a usable value."""

    source: str
    columns: dict[str, str]
    key: tuple[str, ...]
    required: tuple[str, ...]
    renamed: dict[str, str] = field(default_factory=dict)


def _spec(source: str, columns: str, key: str, required: str | None = None, **renamed: str) -> SilverSpec:
    typed = dict(c.split(":") if ":" in c else (c, "text") for c in columns.split())
    return SilverSpec(f"raw.{source}", typed, tuple(key.split()), tuple((required or key).split()), renamed)


# Columns, types and keys of the Silver tables.
SPECS = {
    "stg_customers": _spec(
        "customer_master",
        "customer_id customer_name customer_type channel province region address phone tax_code status "
        "join_date:date credit_limit:num",
        "customer_id",
    ),
    "stg_products": _spec(
        "product_master",
        "product_id product_name category sub_category unit unit_price:num cost_price:num weight_gram:num "
        "status launch_date:date",
        "product_id",
    ),
    "stg_employees": _spec(
        "employee_master",
        "employee_id full_name gender date_of_birth:date join_date:date position region team email phone "
        "status version effective_date:date resign_date:date transfer_note",
        "employee_id effective_date", "employee_id",
    ),
    "stg_distributors": _spec(
        "distributor_master",
        "distributor_id distributor_name tier channel province region contact_person phone email tax_code "
        "join_date:date credit_limit:num status assigned_supervisor_id",
        "distributor_id",
    ),
    "stg_territory_mapping": _spec(
        "territory_mapping",
        "territory_id employee_id customer_id region team effective_date:date expiry_date:date version",
        "territory_id employee_id customer_id effective_date", "territory_id employee_id customer_id",
    ),
    "stg_return_transactions": _spec(
        "return_transactions",
        "return_id original_order_id return_date:date return_month:int customer_id employee_id product_id "
        "region province return_quantity:num unit_price:num return_amount:num return_reason status",
        "return_id",
    ),
    "stg_promotion_program": _spec(
        "promotion_program",
        "promotion_id promotion_name promotion_type target_channel target_region start_date:date end_date:date "
        "applicable_products discount_pct:num min_order_quantity:num budget_vnd:num actual_cost_vnd:num "
        "status created_by",
        "promotion_id",
    ),
    "stg_sales_transactions": _spec(
        "sales_transactions",
        "order_id order_date:date order_month:int order_quarter order_year:int customer_id region province "
        "channel employee_id product_id product_category quantity:num unit_price:num discount_pct:num "
        "discount_amount:num gross_amount:num net_amount:num delivery_status payment_method payment_status",
        "order_id product_id",
    ),
    "stg_distributor_orders": _spec(
        "distributor_orders",
        "order_id order_date:date order_month:int order_quarter distributor_id region channel product_id "
        "product_category qty_ordered:num qty_delivered:num fill_rate_pct:num unit_price_list:num "
        "distributor_price:num gross_amount:num delivered_amount:num expected_delivery_date:date "
        "actual_delivery_date:date on_time_delivery delivery_status payment_terms",
        "order_id distributor_id product_id", on_time_delivery="ontime_delivery",
    ),
}


def silver(spec: SilverSpec, raw: DataFrame, permissive: bool = False, together: Sequence[str] = ()) -> DataFrame:
    """Valid keys, cleaned and typed columns, newest row per cleaned key.

    Strict by default: a malformed date or number fails the model. When
    ``permissive`` it becomes NULL; ``rejected_cells`` counts those.
    """
    return dedupe_latest(_typed(spec, raw, permissive), spec.key, together=together)


def _typed(spec: SilverSpec, raw: DataFrame, permissive: bool) -> DataFrame:
    def converted(name: str, kind: str) -> Column:
        return CONVERT[kind](F.col(spec.renamed.get(name, name)), permissive).alias(name)

    return valid_keys(raw, spec.required).select(
        *[converted(name, kind) for name, kind in spec.columns.items()], *LINEAGE
    )


def silver_keys(spec: SilverSpec, raw: DataFrame, together: Sequence[str] = ()) -> DataFrame:
    """The key columns of ``silver``, row by row, for readers of these alone.

    Every cell is cleaned and typed, so that malformed text is an error here too. Cells beyond key and load time are
    shuffled as one hash, which settles ties: whichever of the tied rows is kept, its key is the same.
    """
    typed = _typed(spec, raw, False)
    others = [c for c in typed.columns if c not in spec.key and c != "_ingested_at"]
    tied = typed.select(*spec.key, "_ingested_at", F.xxhash64(*others).alias("_others"))
    return dedupe_latest(tied, spec.key, together=together).select(*spec.key)


def rejected_cells(spec: SilverSpec, raw: DataFrame) -> DataFrame:
    """One row: per typed column, how many cells hold text that does not convert."""
    def bad(name: str, kind: str) -> Column:
        source = F.col(spec.renamed.get(name, name))
        text = sentinel_to_null(source) if kind == "num" else clean_text(source)
        return F.count_if(text.isNotNull() & CONVERT[kind](source, True).isNull()).alias(name)

    typed = {n: k for n, k in spec.columns.items() if k != "text"}
    return valid_keys(raw, spec.required).agg(*[bad(n, k) for n, k in typed.items()])


def stg_customers(src: Tables) -> DataFrame:
    return silver(SPECS["stg_customers"], src["raw.customer_master"])


def stg_products(src: Tables) -> DataFrame:
    return silver(SPECS["stg_products"], src["raw.product_master"])


def stg_employees(src: Tables) -> DataFrame:
    return silver(SPECS["stg_employees"], src["raw.employee_master"])


def stg_distributors(src: Tables) -> DataFrame:
    return silver(SPECS["stg_distributors"], src["raw.distributor_master"])


def stg_territory_mapping(src: Tables) -> DataFrame:
    return silver(SPECS["stg_territory_mapping"], src["raw.territory_mapping"])


def stg_return_transactions(src: Tables) -> DataFrame:
    return silver(SPECS["stg_return_transactions"], src["raw.return_transactions"])


def stg_promotion_program(src: Tables) -> DataFrame:
    return silver(SPECS["stg_promotion_program"], src["raw.promotion_program"])


def stg_sales_transactions(src: Tables) -> DataFrame:
    return silver(SPECS["stg_sales_transactions"], src["raw.sales_transactions"])


def stg_distributor_orders(src: Tables) -> DataFrame:
    return silver(SPECS["stg_distributor_orders"], src["raw.distributor_orders"])


# Keys of a plan row, and what makes a version the newer one.
PLAN_KEY = ("version_label", "employee_id", "target_year", "month_col")
PLAN_GROUP = ("employee_id", "target_year", "target_month")
PLAN_RECENCY = ("version_rank", "version_date", "_ingested_at")


def typed_targets(raw: DataFrame) -> DataFrame:
    """Plan rows with a valid key and month, typed."""
    year, month = num_to_int("year"), num_to_int("month")
    rows = valid_keys(raw, ["version_label", "employee_id"]).where(is_month_token("month_col"))
    return rows.select(
        clean_text("version_label").alias("version_label"),
        version_rank("version_label").alias("version_rank"),
        *[sentinel_date(c).alias(c) for c in ("version_date", "effective_from", "effective_to")],
        *[clean_text(c).alias(c) for c in ("employee_id", "employee_name", "region", "team")],
        year.alias("target_year"),
        month.alias("target_month"),
        clean_text("month_col").alias("month_col"),
        month_date(year, month).alias("target_month_date"),
        *[to_num(c).alias(c) for c in ("target_revenue", "target_quantity", "target_new_customers")],
        clean_text("sheet_name").alias("sheet_name"),
        *LINEAGE,
    )


def stg_sales_targets_versioned(src: Tables) -> DataFrame:
    """Newest row per version, employee and month; the latest version is marked."""
    newest = dedupe_latest(typed_targets(src["raw.sales_targets_raw"]), PLAN_KEY)
    # Given the group, a row is named by its version and month token.
    flagged = flag_latest(newest, PLAN_GROUP, PLAN_RECENCY, ("version_label", "month_col"))
    at = flagged.columns.index("_source_file")
    others = [c for c in flagged.columns if c != "is_latest"]
    return flagged.select(*others[:at], "is_latest", *others[at:])


SILVER_MODELS = {
    "stg_customers": stg_customers,
    "stg_products": stg_products,
    "stg_employees": stg_employees,
    "stg_distributors": stg_distributors,
    "stg_territory_mapping": stg_territory_mapping,
    "stg_return_transactions": stg_return_transactions,
    "stg_promotion_program": stg_promotion_program,
    "stg_sales_transactions": stg_sales_transactions,
    "stg_distributor_orders": stg_distributor_orders,
    "stg_sales_targets_versioned": stg_sales_targets_versioned,
}
