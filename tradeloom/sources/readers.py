"""Scans: delimited files, sheet folders, dispatch by format, date spine, inventory."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from functools import reduce
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.operators.aggregates import latest
from tradeloom.operators.columns import all_string, normalize_name

# Sheets of a plan workbook that hold no plan.
SKIPPED_SHEETS = frozenset({"summary"})

SHEET = "sheet_name"
CORRUPT = "_corrupt_record"


def read_delimited(
    spark: SparkSession, path: str, schema: StructType | None = None, multi_line: bool = False, permissive: bool = False
) -> DataFrame:
    """Comma-separated text with a header, UTF-8, every cell as text.

    Without a schema the header names the columns. Quotes inside a quoted cell
    are doubled. A row with more or fewer cells than the header is an error. With
    ``permissive`` such rows are kept, with their text in ``_corrupt_record``,
    which is NULL in good rows. Cells spanning lines need ``multi_line``, which
    makes a file one task's work, so it is off unless a source needs it.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        # Rows are checked as a whole, also where a query needs only some columns.
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE" if permissive else "FAILFAST")
    )
    if permissive:
        named = schema or reader.csv(path).schema
        schema = StructType([*named.fields]).add(CORRUPT, "string")
        return reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


#: Table beside the sheets that records the workbook's order: position, sheet_name.
ORDER = "sheet_order"


def sheet_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each sheet of a source landed as ``sheet_name=<name>/`` folders, in the workbook's order.

    The order is what ``sheet_order/`` records. Sheets it does not name follow in name order, as all do without it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    folder = F.regexp_extract("path", rf"/({SHEET}=[^/]*)/[^/]*$", 1).alias("folder")
    found = [r.folder for r in files.select(folder).distinct().where("folder != ''").collect()]
    named = {unquote(f.split("=", 1)[1]): f"{root.rstrip('/')}/{f}" for f in found}
    unrecorded = files.where(F.col("path").rlike(rf"/{ORDER}/[^/]*$")).isEmpty()
    places = {} if unrecorded else {r[SHEET]: r["position"] for r in spark.read.parquet(f"{root.rstrip('/')}/{ORDER}").collect()}
    return {n: named[n] for n in sorted(named, key=lambda n: (n not in places, places.get(n, 0), n))}


def record_order(spark: SparkSession, root: str, sheets: Sequence[str]) -> None:
    """Note the workbook's order of sheets beside the landed sheets: one row a sheet."""
    rows = spark.createDataFrame(list(enumerate(sheets)), f"position int, {SHEET} string")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{ORDER}")


def _sheet(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """One sheet under its own normalised headers, with its name."""
    cells = spark.read.parquet(folder)
    names = [normalize_name(c) for c in cells.columns]
    alike = sorted({n for n in names if names.count(n) > 1})
    if alike:
        raise ValueError(f"sheet {name}: several headers read as {', '.join(alike)}")
    return cells.toDF(*names).withColumn(SHEET, F.lit(name))


def read_sheet(spark: SparkSession, root: str, sheet: str | int = 0) -> DataFrame:
    """One sheet of a source. A number selects by position in the workbook."""
    folders = sheet_folders(spark, root)
    name = list(folders)[sheet] if isinstance(sheet, int) else sheet
    if name not in folders:
        raise ValueError(f"no sheet {name!r} in {root}")
    return _sheet(spark, name, folders[name])


def each_sheet(
    spark: SparkSession, root: str, skip: Iterable[str] = SKIPPED_SHEETS
) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """All sheets of a source but the skipped ones, named in any case; and why others cannot be read."""
    skipped = {s.lower() for s in skip}
    good: dict[str, DataFrame] = {}
    bad: dict[str, str] = {}
    for name, folder in sheet_folders(spark, root).items():
        if name.lower() in skipped:
            continue
        try:
            good[name] = _sheet(spark, name, folder)
        except Exception as problem:  # noqa: BLE001 - one sheet does not keep the others from loading
            bad[name] = str(problem)
    return good, bad


def united(sheets: Iterable[DataFrame]) -> DataFrame:
    """Rows of all sheets by column name, as text; a column that a sheet lacks is NULL in its rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [all_string(s) for s in sheets])


def read_sheets(spark: SparkSession, root: str, skip: Iterable[str] = SKIPPED_SHEETS) -> DataFrame:
    """All sheets of a source but the skipped ones. Each is read under its own headers before they are united."""
    good, bad = each_sheet(spark, root, skip)
    if bad:
        raise ValueError("; ".join(f"{n}: {p}" for n, p in bad.items()))
    if not good:
        raise ValueError(f"no sheet to read in {root}")
    return united(good.values())


def read_source(spark: SparkSession, path: str, sheet: str | int | None = None, multi_line: bool = False) -> DataFrame:
    """Read by the path's suffix, in any case: ``.csv`` is delimited text,
    ``.sheets`` a folder of landed sheets (one sheet, the first unless named),
    ``.parquet`` columnar files."""
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix == ".csv":
        return read_delimited(spark, path, multi_line=multi_line)
    if suffix == ".sheets":
        return read_sheet(spark, path, 0 if sheet is None else sheet).drop(SHEET)
    if suffix == ".parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported source format {suffix!r}: {path}")


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day, both ends included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return spark.range(1).select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("date_day"))


def row_counts(tables: Mapping[str, DataFrame], name: str = "table_name", value: str = "row_count") -> DataFrame:
    """One row per table with its row count, all tables in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(value)).select(F.lit(t).alias(name), value) for t, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def footer_counts(spark: SparkSession, folders: Mapping[str, str], name: str = "table_name", value: str = "row_count") -> DataFrame:
    """One row per Parquet folder with its row count, taken from the files' footers: no column is read.

    The count is pushed into the columnar reader of a session of its own, which shares the application and its catalog
    but not the settings. A folder needs at least one file; hidden files are no part of it.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # Files without row groups report no count at all, which the sum takes for 0.
    total = F.coalesce(F.sum(value), F.lit(0)).alias(value)
    counts = [own.read.parquet(f).agg(F.count(F.lit(1)).alias(value)).agg(total).select(F.lit(t).alias(name), value) for t, f in folders.items()]
    return reduce(DataFrame.unionByName, counts)


def latest_ingest_log(log: DataFrame, n: int = 10) -> DataFrame:
    """Newest load attempts."""
    newest = latest(log, ["finished_at", "started_at", "source_name"], n)
    return newest.select("source_name", "source_file", "rows_loaded", "status", "finished_at")


def source_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Try every source under a folder in full: one row with its size and columns, or the reason it cannot be read.

    Names and one row per source come to the driver; Spark reads and counts the rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    below_root = F.regexp_extract("path", rf"\Q{root.rstrip('/')}/\E([^/]+)", 1)
    entries = [r[0] for r in files.select(below_root.alias("entry")).distinct().orderBy("entry").collect()]
    reports = []
    for entry in entries:
        try:
            df = read_source(spark, f"{root.rstrip('/')}/{entry}")
            reports.append((entry, "OK", df.count(), ", ".join(df.columns), None))
        except Exception as problem:  # noqa: BLE001 - the report is about failures
            reports.append((entry, "FAILED", None, None, str(problem).splitlines()[0]))
    return spark.createDataFrame(reports, _INVENTORY)


_INVENTORY = "source_file string, status string, row_count bigint, columns string, message string"
