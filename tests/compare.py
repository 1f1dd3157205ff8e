"""Comparison of a Spark result with DuckDB's for the same tables."""

from __future__ import annotations

import datetime
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type name for each Spark type.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP",
}


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs: columns, types, row count, values. Empty when equal."""
    result = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in result.description}
    theirs = result.fetchall()
    names = sorted(df.columns)
    if names != sorted(theirs_types):
        return [f"columns {names} / {sorted(theirs_types)}"]
    found = []
    for name, kind in df.dtypes:
        if TYPES.get(kind) != theirs_types[name]:
            found.append(f"type of {name}: {kind} / {theirs_types[name]}")
    order = list(theirs_types)
    ours = sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_key)
    other = sorted((tuple(_plain(r[order.index(n)]) for n in names) for r in theirs), key=_key)
    if len(ours) != len(other):
        found.append(f"{len(ours)} rows / {len(other)}")
    unequal = [(a, b) for a, b in zip(ours, other) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}, columns {names}")
    return found
