"""Bronze transforms: header names, lineage, text cells, plan-sheet normalisation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.functions import mentions_total, missing_to_null, month_token, version_label
from tradeloom.operators.keys import all_of, any_of

LINEAGE = ("_source_file", "_source_platform", "_ingested_at", "_batch_id")

# Columns of a plan sheet and of the normalised plan table.
PLAN_SHEET_COLUMNS = (
    "plan_version", "version_date", "effective_from", "effective_to", "employee_id",
    "employee_name", "region", "team", "year", "month", "target_revenue", "target_quantity",
    "target_new_customers",
)
PLAN_COLUMNS = (
    "version_label", "version_date", "effective_from", "effective_to", "employee_id",
    "employee_name", "region", "team", "year", "month", "month_col", "target_revenue",
    "target_quantity", "target_new_customers", "sheet_name", *LINEAGE,
)


def normalize_name(name: str) -> str:
    """Header text to column name."""
    return str(name).strip().lower().replace(" ", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by ``normalize_name``; no data is touched."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def add_lineage(df: DataFrame, source_file: str, platform: str, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Where the rows came from and when: four constants, one timestamp per batch."""
    return df.withColumns(
        {
            "_source_file": F.lit(source_file),
            "_source_platform": F.lit(platform),
            "_ingested_at": F.lit(ingested_at).cast("timestamp_ntz"),
            "_batch_id": F.lit(batch_id),
        }
    )


def all_string(df: DataFrame) -> DataFrame:
    """Every column as text, except the load time."""
    return df.select(*[F.col(c) if c == "_ingested_at" else F.col(c).cast("string").alias(c) for c in df.columns])


def missing_cells_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL in place of the texts a delimited source writes for a missing value."""
    chosen = df.columns if columns is None else columns
    return df.withColumns({c: missing_to_null(c).alias(c) for c in chosen})


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every cell is NULL."""
    return df.na.drop(how="all", subset=list(columns) if columns else None)


def align(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Add the expected columns a source lacks, as NULL text."""
    return df.withColumns({c: F.lit(None).cast("string") for c in expected if c not in df.columns})


def drop_total_rows(df: DataFrame, columns: Sequence[str] = ("employee_id", "employee_name", "month")) -> DataFrame:
    """Drop rows that a spreadsheet author added as totals."""
    return df.where(all_of([~mentions_total(c) for c in columns]))


# Words of a normalised plan's columns that a leftover total row has.
TOTAL_WORDS = (("employee_id", "tổng"), ("employee_name", "tổng"), ("month_col", "tổng"), ("month_col", "total"))


def total_word() -> Column:
    """Whether a row of a normalised plan still looks like a total (none are expected)."""
    return any_of([F.coalesce(F.lower(F.col(c)).contains(word), F.lit(False)) for c, word in TOTAL_WORDS])


def has_total_word(df: DataFrame) -> DataFrame:
    """Rows of a normalised plan that still look like totals."""
    return df.where(total_word())


def normalize_plan(
    sheets: DataFrame, source_file: str, platform: str, batch_id: str, ingested_at: datetime
) -> DataFrame:
    """All plan sheets, as rows with a ``sheet_name``, into the plan table's shape.

    One narrow pass over all sheets together: the sheet name is an ordinary
    column, so there is no loop over sheets and no shuffle.
    """
    cells = [c for c in sheets.columns if c != "sheet_name"]
    renamed = sheets.toDF(*[c if c == "sheet_name" else normalize_name(c) for c in sheets.columns])
    cleaned = drop_empty_rows(renamed, [normalize_name(c) for c in cells])
    rows = (
        drop_total_rows(align(cleaned, PLAN_SHEET_COLUMNS))
        .withColumn("version_label", version_label("sheet_name"))
        .withColumn("month_col", month_token("month"))
        .where(F.col("month_col").isNotNull())
    )
    return all_string(add_lineage(rows, source_file, platform, batch_id, ingested_at).select(*PLAN_COLUMNS))


def target_load_report(targets_raw: DataFrame) -> DataFrame:
    """What a plan load left behind: rows per version and per month, leftover totals. One scan, by grouping sets.

    A version or month that is NULL is told from a total by the grouping. The count of leftovers is there, as 0, for
    an empty table as well.
    """
    text = lambda c: F.col(c).cast("string")
    by_version, by_month = F.col("kind") == 1, F.col("kind") == 2
    counted = targets_raw.groupingSets([[F.col("version_label")], [F.col("month_col")], []], "version_label", "month_col").agg(
        F.grouping_id().alias("kind"), F.count(F.lit(1)).alias("rows"), F.count_if(total_word()).alias("totals")
    )
    report = counted.select(
        F.when(by_version, "rows per version").when(by_month, "rows per month").otherwise("total rows").alias("item"),
        F.when(by_version, text("version_label")).when(by_month, text("month_col")).alias("member"),
        F.when(by_version | by_month, F.col("rows")).otherwise(F.col("totals")).alias("value"),
    )
    none = targets_raw.sparkSession.range(1).select(F.lit("total rows").alias("item"), F.lit(None).cast("string").alias("member"), F.lit(0).cast("long").alias("value"))
    return report.unionByName(none).groupBy("item", "member").agg(F.sum("value").alias("value"))
