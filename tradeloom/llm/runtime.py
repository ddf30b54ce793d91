"""What the operators share: code on the executors, tables of a folder, stored steps."""

from __future__ import annotations

import ctypes
import gc
import io
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import new_folder

_shipped: set[str] = set()
_steps: dict[str, list[str]] = {}
_running: tuple[str, Callable[[], object] | None] = ("", None)


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, once for each application.

    The archive goes out through the driver's file server, so executors need no folder in common.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    path = os.path.join(tempfile.mkdtemp(prefix="tradeloom-code-"), f"tradeloom-{app}.zip")
    with open(path, "wb") as f:
        f.write(archive.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def begins(step: str, release: Callable[[], object] | None = None) -> None:
    """Called by a step's tasks in their worker; ``release`` drops what they leave there for the tasks that follow.

    A worker outlives its step, and an executor has one for each core. So that a chain of steps holds no more than
    its largest, the first task of another step releases what the step before it left, and gives the memory back.
    """
    global _running
    before, drop = _running
    if before == step:
        return
    _running = (step, release)
    if drop:
        drop()
    if before:
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has and needs it
        if trim:
            trim(0)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back: later steps neither repeat it nor depend on its executors."""
    path = new_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    _steps.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_steps(spark: SparkSession) -> None:
    """Delete the steps that this application has stored, once the results that read them are written."""
    for path in _steps.pop(spark.sparkContext.applicationId, []):
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def thinned(rows: DataFrame, key: Column, n: int, within: str | None = None) -> DataFrame:
    """All rows of about 2 n different keys (of each value of ``within``), the least by a hash; of all keys where there are fewer.

    What a sample of n is then taken from is small before it is sorted or sent anywhere, at any number of tasks. The
    share is set by the different keys, counted by their hashes and combined before the shuffle: copies of a key
    neither lower it nor meet in one task. Equal keys share a hash, so whoever draws by text makes equal texts one row
    afterwards. The values of ``within`` are broadcast with their counts: they are a model's classes, which every
    worker holds anyway.
    """
    draw = F.pmod(F.xxhash64(key), F.lit(1 << 32))
    keys = rows.select(*([within] if within else []), F.xxhash64(key).alias("__key")).distinct()
    if within is None:
        share = min(1.0, 2 * n / max(1, keys.count()))
        return rows.where(draw < share * 2**32)
    counts = keys.groupBy(within).agg(F.count(F.lit(1)).alias("__n"))
    return rows.join(F.broadcast(counts), within).where(draw < F.least(F.lit(1.0), 2 * n / F.col("__n")) * 2**32).drop("__n")


def windowed(rows: DataFrame, text_col: str, size: int) -> DataFrame:
    """Every text cut into windows of ``size`` bytes, its last one shorter, in its place; ``cut`` tells whether it has several.

    A text of at most ``size`` bytes is its only window. A character cut in two becomes a replacement character. Bytes
    are cut, as a place in them is found at once, so that a long text costs one pass. Null and empty texts have none.
    """
    raw = F.col(text_col).cast("binary")
    parts = F.transform(F.sequence(F.lit(0), ((F.octet_length(text_col) - 1) / size).cast("int")), lambda k: F.make_valid_utf8(F.substring(raw, k * size + 1, F.lit(size)).cast("string")))
    rows = rows.where(F.octet_length(text_col) > 0).withColumn("cut", F.octet_length(text_col) > size)
    whole = F.when(F.col("cut"), parts).otherwise(F.array(text_col))
    return rows.select(*(F.col(c) for c in rows.columns if c != text_col), F.explode(whole).alias(text_col))


def utf8(text: Column) -> Column:
    """A text's bytes, none for null: Python workers then need not decode what they only cut."""
    return F.coalesce(text.cast("binary"), F.lit(b""))


def rows(batch: pa.RecordBatch, columns: dict[str, list], schema: pa.Schema) -> pa.RecordBatch:
    """A batch of the given schema; columns not given are taken from ``batch``."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else batch.column(f.name) for f in schema], schema=schema
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice's ``column`` holds about ``limit`` bytes, or is one row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + (n or 0) > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if batch.num_rows > start:
            yield batch.slice(start)


class Rewritten:
    """A step that is written anew in every turn of a loop; the turn before is deleted once the next is whole.

    The disk then holds two turns at most, and a lost executor costs a part of one.
    """

    def __init__(self, name: str):
        self.name = name
        self.path: str | None = None

    def write(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        now = stored(df, self.name)
        steps = _steps[spark.sparkContext.applicationId]
        if self.path:
            folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            steps.remove(self.path)
        self.path = steps[-1]
        return now
