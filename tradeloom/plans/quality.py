"""Data-quality checks and profiling, as rows instead of printed lines."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradeloom.functions import count_where, is_missing_key
from tradeloom.operators.keys import any_of, duplicate_keys, excess_duplicates
from tradeloom.plans.silver import PLAN_GROUP, PLAN_KEY, SPECS
from tradeloom.sources.specs import PROFILED, SourceSpec

Tables = Mapping[str, DataFrame]

RESULT, FAILURES = "result", "failures"

SILVER_KEYS = {**{t: s.key for t, s in SPECS.items()}, "stg_sales_targets_versioned": PLAN_KEY}
SILVER_REQUIRED = {
    **{t: s.required for t, s in SPECS.items()},
    "stg_sales_targets_versioned": ("version_label", "employee_id", "month_col"),
}

# Keys and grains of the Gold tables.
DIMENSION_KEYS = {
    "dim_date": "date_key",
    "dim_customers": "customer_key",
    "dim_products": "product_key",
    "dim_employees": "employee_key",
    "dim_distributors": "distributor_key",
}
FACT_GRAINS = {
    "fact_sales": ("order_id", "product_id"),
    "fact_returns": ("return_id",),
    "fact_targets": PLAN_GROUP,
    "fact_distributor_orders": ("order_id", "distributor_id", "product_id"),
}
FACT_FOREIGN_KEYS = {
    "fact_sales": ("order_date_key", "customer_key", "product_key", "employee_key"),
    "fact_returns": ("return_date_key", "customer_key", "product_key", "employee_key"),
    "fact_targets": ("target_date_key", "employee_key"),
    "fact_distributor_orders": ("order_date_key", "distributor_key", "product_key"),
}
GOLD_COUNTED = (*DIMENSION_KEYS, *FACT_GRAINS, "mart_sales_vs_target", "mart_distributor_performance")


# What a composite key is called in a check's name.
KEY_PHRASES = {
    ("employee_id", "effective_date"): "employee effective record",
    ("territory_id", "employee_id", "customer_id", "effective_date"): "mapping",
    ("order_id", "product_id"): "order product",
    ("order_id", "distributor_id", "product_id"): "order distributor product",
    PLAN_KEY: "version target",
    PLAN_GROUP: "employee month",
}


def key_phrase(keys: Sequence[str]) -> str:
    return keys[0] if len(keys) == 1 else KEY_PHRASES.get(tuple(keys), "key")


def _check(counted: DataFrame, layer: str, test_name: str, kind: str) -> DataFrame:
    return counted.select(
        F.lit(layer).alias("layer"), F.lit(test_name).alias("test_name"), F.lit(kind).alias("kind"),
        F.col("value").cast("long").alias("value"),
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class RowRule:
    """A check that is one aggregate over a table's rows, so that any number of them share a scan or a write."""

    table: str
    layer: str
    test_name: str
    kind: str
    value: Callable[[], Column]


class RowChecks:
    """Row rules as a check of their own: one row each."""

    def __init__(self, rules: Sequence[RowRule]):
        self.rules = tuple(rules)

    def __call__(self, src: Tables) -> DataFrame:
        return rule_report(src, self.rules)


def rule_report(src: Tables, rules: Sequence[RowRule]) -> DataFrame:
    """One row per rule. Each table is scanned once for all of its rules, and only for the columns they need."""
    by_table: dict[str, list[RowRule]] = {}
    for rule in rules:
        by_table.setdefault(rule.table, []).append(rule)
    return union_all([_rows_of(src[table], own) for table, own in by_table.items()])


def _rows_of(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    one = [
        F.struct(
            F.lit(r.layer).alias("layer"), F.lit(r.test_name).alias("test_name"), F.lit(r.kind).alias("kind"),
            r.value().cast("long").alias("value"),
        )
        for r in rules
    ]
    return df.agg(F.array(*one).alias("rules")).select(F.inline("rules"))


def observed(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The rows, whose rules are counted while they are written; and the report's rows, once they are.

    Nothing is scanned for the report: the counts come with the action that writes the table.
    """
    if not rules:
        return df, lambda: []
    seen = Observation()
    watched = df.observe(seen, *[r.value().cast("long").alias(f"rule{i}") for i, r in enumerate(rules)])
    return watched, lambda: [(r.layer, r.test_name, r.kind, seen.get[f"rule{i}"]) for i, r in enumerate(rules)]


REPORT = "layer string, test_name string, kind string, value bigint"


def report_of(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Report rows that writes have observed: one a rule."""
    return spark.createDataFrame(list(rows), REPORT)


def broken(failing: Callable[[], Column]) -> Callable[[], Column]:
    """Rows for which a rule is broken."""
    return lambda: count_where(failing())


def rule_check(layer: str, test_name: str, df: DataFrame, failing: Column) -> DataFrame:
    """Rows for which the rule is broken."""
    return _check(df.agg(count_where(failing).alias("value")), layer, test_name, FAILURES)


def row_count_rules(layer: str, tables: Sequence[str]) -> list[RowRule]:
    return [RowRule(t, layer, f"{t} row count", RESULT, lambda: F.count(F.lit(1))) for t in tables]


def _any_null(columns: Sequence[str]) -> Callable[[], Column]:
    return broken(lambda: any_of([F.col(c).isNull() for c in columns]))


def not_null_rules(layer: str, keys: Mapping[str, Sequence[str]]) -> list[RowRule]:
    return [RowRule(t, layer, f"{t} {k[0] if len(k) == 1 else 'key'} nulls", FAILURES, _any_null(k)) for t, k in keys.items()]


def missing_key_rules(layer: str, keys: Mapping[str, Sequence[str]]) -> list[RowRule]:
    """Fact rows that found no member in some dimension."""
    return [RowRule(t, layer, f"{t} missing dimension keys", FAILURES, _any_null(k)) for t, k in keys.items()]


def unique_checks(
    layer: str, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], what: str | None = None
) -> DataFrame:
    """Number of keys held by more than one row."""
    def repeated(df: DataFrame, t: str) -> DataFrame:
        return duplicate_keys(df, keys[t]).agg(F.count(F.lit(1)).alias("value"))

    return union_all(
        [
            _check(repeated(df, t), layer, f"{t} duplicate {what or key_phrase(keys[t])}", FAILURES)
            for t, df in tables.items()
        ]
    )


def _pick(src: Tables, names) -> dict[str, DataFrame]:
    return {n: src[n] for n in names}


silver_row_counts = RowChecks(row_count_rules("silver", list(SILVER_KEYS)))
silver_not_null = RowChecks(not_null_rules("silver", SILVER_REQUIRED))


def silver_unique(src: Tables) -> DataFrame:
    return unique_checks("silver", _pick(src, SILVER_KEYS), SILVER_KEYS)


def one_latest(src: Tables) -> DataFrame:
    name = "stg_sales_targets_versioned"
    return unique_checks("silver", {name: src[name].where("is_latest")}, {name: PLAN_GROUP}, "latest target")


gold_row_counts = RowChecks(row_count_rules("gold", GOLD_COUNTED))
dimension_not_null = RowChecks(not_null_rules("gold", {t: [k] for t, k in DIMENSION_KEYS.items()}))


def dimension_unique(src: Tables) -> DataFrame:
    return unique_checks("gold", _pick(src, DIMENSION_KEYS), {t: [k] for t, k in DIMENSION_KEYS.items()})


def fact_grain(src: Tables) -> DataFrame:
    return unique_checks("gold", _pick(src, FACT_GRAINS), FACT_GRAINS)


missing_keys = RowChecks(missing_key_rules("gold", FACT_FOREIGN_KEYS))


# Days whose fiscal year is known.
FISCAL_EXAMPLES = {"2023-10-01": 2023, "2024-01-01": 2023}


def _wrong_fiscal_year() -> Column:
    return any_of(
        [
            (F.col("date_day") == F.lit(day).cast("date")) & (F.col("fiscal_year") != year)
            for day, year in FISCAL_EXAMPLES.items()
        ]
    )


def _rule(table: str, what: str, failing: Callable[[], Column]) -> RowChecks:
    return RowChecks([RowRule(table, "gold", f"{table} {what}", FAILURES, broken(failing))])


fiscal_year_check = _rule("dim_date", "fiscal year check", _wrong_fiscal_year)
latest_flag_check = _rule("fact_targets", "latest flag check", lambda: ~F.col("is_latest").eqNullSafe(True))
negative_target_check = _rule("mart_sales_vs_target", "negative target revenue", lambda: F.col("target_revenue") < 0)
fill_rate_check = _rule(
    "mart_distributor_performance", "invalid fill rate", lambda: (F.col("fill_rate_pct") < 0) | (F.col("fill_rate_pct") > 100)
)


SILVER_CHECKS = (silver_row_counts, silver_not_null, silver_unique, one_latest)
GOLD_CHECKS = (
    gold_row_counts, dimension_not_null, dimension_unique, fact_grain, missing_keys, fiscal_year_check,
    latest_flag_check, negative_target_check, fill_rate_check,
)


def run_checks(src: Tables, checks=(*SILVER_CHECKS, *GOLD_CHECKS), strict: bool = False) -> DataFrame:
    """All checks as one DataFrame; in strict mode any failing check is an error.

    The row rules of all checks are put together, so that a table is scanned once for them; keys are counted apart.
    """
    rules = [r for check in checks if isinstance(check, RowChecks) for r in check.rules]
    frames = [rule_report(src, rules)] if rules else []
    report = union_all(frames + [check(src) for check in checks if not isinstance(check, RowChecks)])
    if strict:
        broken = report.where((F.col("kind") == FAILURES) & (F.col("value") > 0)).collect()  # at most one row per check
        if broken:
            raise ValueError("; ".join(f"{r.test_name}: {r.value}" for r in broken))
    return report


def row_rules(table: str, checks=(*SILVER_CHECKS, *GOLD_CHECKS)) -> list[RowRule]:
    """The row rules of one table, for its write."""
    return [r for check in checks if isinstance(check, RowChecks) for r in check.rules if r.table == table]


def profile_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def profile_key_nulls(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key column, how many cells are missing and their share; one pass for all columns."""
    missing = [count_where(is_missing_key(k)).alias(k) for k in keys]
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *missing)
    per_column = F.explode(
        F.array(*[F.struct(F.lit(k).alias("column_name"), F.col(k).alias("null_count")) for k in keys])
    )
    share = F.when(F.col("row_count") > 0, F.round(F.col("null_count") * 100 / F.col("row_count"), 2)).otherwise(F.lit(0.0))
    return (
        counts.select("row_count", per_column.alias("c"))
        .select("c.column_name", "c.null_count", "row_count")
        .withColumn("null_pct", share)
    )


def profile_table(name: str, df: DataFrame, spec: SourceSpec) -> DataFrame:
    """One row: size, excess rows of the business key, missing key cells. One scan: all follow from counts per key."""
    missing = [count_where(is_missing_key(k)).alias(f"_missing_{k}") for k in spec.profile_keys]
    per_key = df.groupBy(*spec.grain).agg(F.count(F.lit(1)).alias("_rows"), *missing)

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0))

    cells = [F.concat(F.lit(f"{k}: "), total(F.col(f"_missing_{k}")).cast("string")) for k in spec.profile_keys]
    return per_key.agg(
        total(F.col("_rows")).alias("row_count"),
        total(F.col("_rows") - 1).alias("duplicate_count"),
        F.array_join(F.array(*cells), ", ").alias("key_nulls"),
    ).select(
        F.lit(name).alias("profile_name"), "row_count", "duplicate_count", F.lit(", ".join(spec.grain)).alias("duplicate_columns"), "key_nulls"
    )


def profile_tables(src: Tables, specs: Mapping[str, SourceSpec] = PROFILED) -> DataFrame:
    """Profile of every Bronze table."""
    return union_all([profile_table(t, src[f"raw.{t}"], s) for t, s in specs.items()])


def profile_all_key_nulls(src: Tables, specs: Mapping[str, SourceSpec] = PROFILED) -> DataFrame:
    return union_all(
        [
            profile_key_nulls(src[f"raw.{t}"], s.profile_keys).select(F.lit(t).alias("profile_name"), "*")
            for t, s in specs.items()
        ]
    )


def profile_all_duplicates(src: Tables, specs: Mapping[str, SourceSpec] = PROFILED) -> DataFrame:
    return union_all(
        [
            excess_duplicates(src[f"raw.{t}"], s.grain).select(F.lit(t).alias("profile_name"), "duplicate_count")
            for t, s in specs.items()
        ]
    )
