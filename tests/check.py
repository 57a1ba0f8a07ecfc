"""Compares a Spark result with the same query in DuckDB, value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return value


def _order(row):
    """Sort key that puts NULL after any value and never compares two types."""
    return [(value is None, type(value).__name__, value) if value is not None else (True, "", 0) for value in row]


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_order)


# The SQL name of each Spark type.
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare_types(spark_df, con, sql: str) -> str:
    """Empty if column names and types agree, else both sides."""
    want = sorted((d[0], d[1]) for d in con.execute(f"DESCRIBE {sql}").fetchall())
    got = sorted((name, SQL_TYPES.get(kind, kind)) for name, kind in spark_df.dtypes)
    return "" if got == want else f"{[g for g in got if g not in want]} != {[w for w in want if w not in got]}"


def compare(spark_df, con, sql: str) -> str:
    """Empty if columns and all rows agree, else what differs."""
    result = con.execute(sql)
    want = _sorted([d[0] for d in result.description], result.fetchall())
    got = _sorted(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    for g, w in zip(got[1], want[1], strict=True):
        if g != w or [type(v) for v in g] != [type(v) for v in w]:
            return f"{g} != {w}"
    return ""
