"""Layered tables: append, full refresh, slice replacement, scan."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.operators.columns import all_string, normalize_columns
from tradeloom.operators.keys import all_of, any_of
from tradeloom.sources.buckets import Buckets, buckets_of

# Namespaces of the three layers.
LAYERS = ("raw", "staging", "dwh")


class Warehouse:
    """Parquet tables in three namespaces of the session catalog.

    ``root`` is a folder every executor can reach. ``prefix`` keeps the
    namespaces of several warehouses of one catalog apart.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def ensure_layers(self) -> DataFrame:
        """Create the namespaces if absent; list them."""
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.namespace(layer)} LOCATION '{self.root}/{layer}'"
            )
        wanted = [self.namespace(layer) for layer in LAYERS]
        return self.spark.sql("SHOW DATABASES").where(F.col("namespace").isin(wanted))

    def namespace(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.namespace(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def ensure_table(self, layer: str, table: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
        """Create an empty typed table unless it exists."""
        if self.exists(layer, table):
            return
        writer = self.spark.createDataFrame([], schema).write.format("parquet")
        if partition_by:
            # An overwrite of this table replaces only the partitions that get rows.
            writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
        writer.saveAsTable(self.name(layer, table))

    def append(self, df: DataFrame, layer: str, table: str) -> int:
        """Append rows; the count is observed by the write itself, not by a second job."""
        seen = Observation()
        counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.mode("append").format("parquet").saveAsTable(self.name(layer, table))
        return seen.get["rows"]

    def append_bronze(self, df: DataFrame, table: str) -> int:
        """Append to Bronze: normalised names, text cells, one timestamp."""
        return self.append(all_string(normalize_columns(df)), "raw", table)

    def materialize(
        self, df: DataFrame, layer: str, table: str, date: str | None = None, watch: Callable[[DataFrame], DataFrame] | None = None,
        buckets: Buckets | None = None,
    ) -> DataFrame:
        """Replace a table by the rows of ``df``, laid out by ``buckets`` or by ``date`` if given. ``watch`` may observe what
        is written.

        The rows go to a new folder below the root and the table is pointed at it
        once they are all written, so a failed job leaves the old table as it was
        and a model may read the table it replaces. The replaced version stays for
        readers that are still at it; versions before that are removed. A table is
        refreshed by one writer at a time.
        """
        home = f"{self.root}/{layer}/{self.prefix}{table}"
        folder = f"{home}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        laid_out = buckets.deal(df) if buckets else by_month(df, date) if date else df
        # Observed after the layout: adaptive execution cuts off what precedes an empty exchange.
        written = watch(laid_out) if watch else laid_out
        target = self.name(layer, table)
        # Files are dealt to buckets by the catalog alone, so such a table is written under a name of its own.
        coming = self.name(layer, f"{table}_{uuid.uuid4().hex[:8]}")
        if buckets:
            buckets.writer(written).option("path", folder).saveAsTable(coming)
        else:
            written.write.parquet(folder)
            self.spark.catalog.createTable(coming, path=folder, source="parquet")
        replaced = self._version_of(target) if self.exists(layer, table) else None
        if replaced and self._shape(target) == self._shape(coming):
            self.spark.sql(f"ALTER TABLE {target} SET LOCATION '{folder}'")
            self.spark.catalog.refreshTable(target)
            self.spark.sql(f"DROP TABLE {coming}")  # its files are the table's now
        else:
            if replaced:
                self.spark.sql(f"DROP TABLE {target}")
            self.spark.sql(f"ALTER TABLE {coming} RENAME TO {target}")
        if replaced:
            self._remove_before(home, replaced)
        return self.table(layer, table)

    def location(self, layer: str, table: str) -> str:
        """Folder of a table's files."""
        described = self.spark.sql(f"DESCRIBE EXTENDED {self.name(layer, table)}").where("col_name = 'Location'")
        return described.first()["data_type"]

    def buckets(self, layer: str, table: str) -> tuple[int, tuple[str, ...]] | None:
        """Count and columns of a table's buckets; None if it has none."""
        return buckets_of(self.spark.sql(f"DESCRIBE EXTENDED {self.name(layer, table)}").collect())

    def _shape(self, target: str) -> tuple:
        """What two versions of a table must share for one to take the other's place by its files alone."""
        return self.spark.table(target).schema, buckets_of(self.spark.sql(f"DESCRIBE EXTENDED {target}").collect())

    def _version_of(self, target: str) -> str:
        described = self.spark.sql(f"DESCRIBE EXTENDED {target}").where("col_name = 'Location'")
        return described.first()["data_type"].rstrip("/").rsplit("/", 1)[-1]

    def _remove_before(self, home: str, version: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(home)
        files = folder.getFileSystem(conf)
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("v-") and name < version:
                files.delete(status.getPath(), True)

    def replace_slice(
        self, df: DataFrame, layer: str, table: str, slice_columns: Sequence[str], slices: Sequence[Mapping[str, str]]
    ) -> list[int]:
        """Replace the named slices of a partitioned table; other slices are untouched.

        The rows are written once, to a new folder, and counted by that write. If
        some are outside the named slices, that is an error and nothing is
        published. Each slice is then replaced by one change of the catalog: its
        partition is pointed at the new files, or dropped if it came back empty, so
        no reader meets a slice half replaced. Running it again changes nothing.
        Returns the rows per slice. Files that are replaced stay for readers that
        are still at them, until ``remove_unreferenced``.
        """
        if not slices:
            if not df.isEmpty():
                raise ValueError("rows, but no slice to replace")
            return []
        target = self.name(layer, table)
        if not self.exists(layer, table):
            self.ensure_table(layer, table, slices_last(df.schema, slice_columns), slice_columns)
        folder = f"{self._slices_home(layer, table)}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        seen = Observation()
        stray = F.count_if(~F.coalesce(any_slice(slices), F.lit(False))).alias("stray")
        example = F.first(F.when(~F.coalesce(any_slice(slices), F.lit(False)), F.to_json(F.struct(*slice_columns))), ignorenulls=True).alias("example")
        per_slice = [F.count_if(in_slice(s)).alias(f"slice{i}") for i, s in enumerate(slices)]
        # A slice's rows are brought together so that it gets few files; a large slice is split.
        grouped = df.hint("rebalance", *slice_columns)
        # Counted after the exchange: adaptive execution cuts off what precedes an empty one.
        counted = grouped.select(*self.table(layer, table).columns).observe(seen, stray, example, *per_slice)
        counted.write.partitionBy(*slice_columns).parquet(folder)
        if seen.get["stray"]:
            self._delete(folder)
            raise ValueError(f"a row outside the slices: {seen.get['example']}")
        counts = [seen.get[f"slice{i}"] for i in range(len(slices))]
        written = self._partition_folders(folder, len(slice_columns))
        for s, rows in zip(slices, counts):
            values = ", ".join(f"{c} = '{_quoted(s[c])}'" for c in slice_columns)
            if rows:
                place = written[tuple(s[c] for c in slice_columns)]
                self._point(target, values, place)
            else:
                self.spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({values})")
        self.spark.catalog.refreshTable(target)
        return counts

    def remove_unreferenced(self, layer: str, table: str) -> int:
        """Delete slice versions that no partition of the table points into any more; returns how many."""
        target, home = self.name(layer, table), self._slices_home(layer, table)
        used = set()
        for r in self.spark.sql(f"SHOW PARTITIONS {target}").collect():  # one row a slice
            parts = [p.split("=", 1) for p in r[0].split("/")]
            values = ", ".join(f"{c} = '{_quoted(unquote(v))}'" for c, v in parts)
            described = self.spark.sql(f"DESCRIBE EXTENDED {target} PARTITION ({values})").where("col_name = 'Location'")
            used.add(described.first()["data_type"].rstrip("/").split("/")[-1 - len(parts)])
        folder, files = self._files(home)
        old = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() not in used]
        for path in old:
            files.delete(path, True)
        return len(old)

    def _slices_home(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{self.prefix}{table}.slices"

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _delete(self, path: str) -> None:
        folder, files = self._files(path)
        files.delete(folder, True)

    def _partition_folders(self, root: str, levels: int) -> dict[tuple[str, ...], str]:
        """Folders of a partitioned write by their values: one a slice."""
        folder, files = self._files(root + "/*=*" * levels)
        found = {}
        for status in files.globStatus(folder) or []:
            place = status.getPath().toString()
            found[tuple(unquote(p.split("=", 1)[1]) for p in place.split("/")[-levels:])] = place
        return found

    def _point(self, target: str, values: str, place: str) -> None:
        """Let a partition be the files of a folder, in one change of the catalog."""
        if self.spark.sql(f"SHOW PARTITIONS {target} PARTITION ({values})").isEmpty():
            self.spark.sql(f"ALTER TABLE {target} ADD PARTITION ({values}) LOCATION '{_quoted(place)}'")
        else:
            self.spark.sql(f"ALTER TABLE {target} PARTITION ({values}) SET LOCATION '{_quoted(place)}'")


def slices_last(schema: StructType, slice_columns: Sequence[str]) -> StructType:
    """The schema with its partition columns at the end, in the given order."""
    own = [f for f in schema.fields if f.name not in slice_columns]
    return StructType(own + [schema[c] for c in slice_columns])


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Rows of a month written together and in date order, so that a date range skips most files.

    The months are rebalanced, not hashed: adaptive execution splits a month that
    is too large for one task and puts small ones together.
    """
    month = F.trunc(df[date], "month")
    return df.withColumn("_month", month).hint("rebalance", "_month").sortWithinPartitions(date).drop("_month")


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def in_slice(one: Mapping[str, str]) -> Column:
    return all_of([F.col(column) == value for column, value in one.items()])


def any_slice(slices: Sequence[Mapping[str, str]]) -> Column:
    """Rows that belong to one of the slices."""
    return any_of([in_slice(s) for s in slices]) if slices else F.lit(False)
