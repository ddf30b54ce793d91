"""Run a registered query on Spark and its SQL on DuckDB; compare columns, types and rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(folder: str):
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def _value(v):
    return "NaN" if isinstance(v, float) and math.isnan(v) else v


def differences(df, connection, sql: str) -> list[str]:
    """What differs between a DataFrame and a statement; empty when equal."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    duck_types = {r[0]: r[1] for r in described}
    spark_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if duck_types.keys() != spark_types.keys():
        return [f"columns differ: only Spark {spark_types.keys() - duck_types.keys()}, only SQL {duck_types.keys() - spark_types.keys()}"]
    found = [f"type of {c}: {spark_types[c]} / {duck_types[c]}" for c in spark_types if spark_types[c] != duck_types[c]]
    names = sorted(spark_types)
    ours = Counter(tuple(_value(r[c]) for c in names) for r in df.collect())
    at = [list(duck_types).index(c) for c in names]
    theirs = Counter(tuple(_value(r[i]) for i in at) for r in connection.execute(sql).fetchall())
    if ours != theirs:
        only_ours, only_theirs = ours - theirs, theirs - ours
        found.append(
            f"rows: {sum(ours.values())} / {sum(theirs.values())}, {sum(only_ours.values())} only in Spark, "
            f"{sum(only_theirs.values())} only in SQL; {names}; {list(only_ours)[:1]} / {list(only_theirs)[:1]}"
        )
    return found
