"""Tables bucketed by a key: what groups by that key, and more, needs no exchange.

The shuffle is paid once, by the write. Duplicate and grain checks, the newest row
per key and distinct counts of the key then run in the scan's own stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter


@dataclass(frozen=True)
class Buckets:
    """How a table is dealt: ``count`` buckets by the hash of ``columns``, each sorted by ``sort``.

    A bucket is read by one task wherever its grouping is used, so ``count`` is chosen for a bucket of some 200 MB. Sorting
    by the date that the table is sliced by lets a slice skip row groups of a bucket.
    """

    columns: tuple[str, ...]
    count: int
    sort: tuple[str, ...] = ()

    def deal(self, df: DataFrame) -> DataFrame:
        """Rows of a bucket brought together, so that it gets few files.

        Rebalanced, not repartitioned: adaptive execution splits a bucket with a hot key among tasks, which write a file
        each, and lets one task write several small buckets. NULL keys are a bucket like another.
        """
        return df.hint("rebalance", self.count, *self.columns)

    def writer(self, df: DataFrame) -> DataFrameWriter:
        writer = df.write.format("parquet").bucketBy(self.count, self.columns[0], *self.columns[1:])
        return writer.sortBy(self.sort[0], *self.sort[1:]) if self.sort else writer


def buckets_of(described: Sequence) -> tuple[int, tuple[str, ...]] | None:
    """Count and columns of the buckets in the rows of DESCRIBE EXTENDED, None for a table without."""
    found = {r["col_name"]: r["data_type"] for r in described}
    if "Num Buckets" not in found:
        return None
    columns = tuple(c.strip().strip("`") for c in found["Bucket Columns"].strip("[]").split(","))
    return int(found["Num Buckets"]), columns
