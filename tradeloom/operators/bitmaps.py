"""Distinct counts that add up: bitmaps of dense numbers, united for any grouping.

A bitmap holds 32,768 consecutive numbers. Rows of a group are kept for each
bucket of numbers that occurs in it, so their number follows from how near each
other a group's numbers are: number members in the order of the groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND, BUCKET, BITS = "counted", "bucket", "bits"


def activity(df: DataFrame, by: Mapping[str, Column], numbers: Mapping[str, str], sums: Mapping[str, str]) -> DataFrame:
    """Per group, counted thing and bucket: the bitmap of its numbers, and sums that add up over all rows.

    ``numbers`` maps a name to a column of dense positive numbers; a missing number counts as nothing. ``sums`` maps
    new names to columns. One scan and one shuffle: a row meets each bitmap on its map task, where groups are combined
    before they move. Sums ride on the first counted thing.
    """
    first = next(iter(numbers))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).cast("long").alias("number")) for n, c in numbers.items()]))
    named = df.select(*[c.alias(n) for n, c in by.items()], *[F.col(c).alias(f"_{n}") for n, c in sums.items()], each.alias("_c"))
    own = F.col("_c.name") == first
    return named.groupBy(*by, F.col("_c.name").alias(KIND), F.bitmap_bucket_number("_c.number").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_c.number")).alias(BITS),
        *[F.sum(F.when(own, F.col(f"_{n}"))).alias(n) for n in sums],
    )


def roll_up(rows: DataFrame, by: Sequence[str], counted: Mapping[str, str], sums: Sequence[str] = ()) -> DataFrame:
    """Distinct counts and sums of ``activity`` rows for any grouping of its columns.

    ``counted`` maps names of counted things to new names. Bitmaps of a bucket are united, then their bits are added.
    """
    united = rows.groupBy(*by, KIND, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(s).alias(s) for s in sums])
    total = {n: F.coalesce(F.sum(F.when(F.col(KIND) == k, F.bitmap_count(BITS))), F.lit(0)).alias(n) for k, n in counted.items()}
    return united.groupBy(*by).agg(*total.values(), *[F.sum(s).alias(s) for s in sums])
