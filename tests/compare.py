"""Comparing a Spark result with the same query run by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events"
    " documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _key(row):
    return tuple((value is not None, str(type(value)), value) if value is not None else (False, "", "") for value in row)


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=_key)


# Spark and DuckDB names of the types the queries return.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def expected(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[dict[str, str], list]:
    """Names and types of the columns of a query, and its rows."""
    found = con.execute(sql)
    return {column[0]: str(column[1]) for column in found.description}, found.fetchall()


def assert_same_rows(schema, rows, types: dict[str, str], want: list) -> int:
    """The same columns, types and rows, in any order; returns the row count."""
    names = schema.names
    assert sorted(names) == sorted(types)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in schema.fields} == types
    want_rows = sorted_rows(list(types), want)
    got_rows = sorted_rows(names, rows)
    assert len(got_rows) == len(want_rows)
    for got_row, want_row in zip(got_rows, want_rows):
        assert got_row == want_row
    return len(got_rows)


def assert_same(df, con: duckdb.DuckDBPyConnection, sql: str) -> int:
    return assert_same_rows(df.schema, df.collect(), *expected(con, sql))
