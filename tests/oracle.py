"""Compare a Spark result with DuckDB, column by column and row by row."""

from __future__ import annotations

import datetime as dt
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("double", f"{value:.12g}")
    if isinstance(value, bool):
        return ("flag", value)
    if isinstance(value, dt.datetime):
        return ("time", value.isoformat())
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [item[0] for item in result.description]
    expected = result.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = [tuple(row) for row in frame.collect()]
    left, right = rows_of(frame.columns, actual), rows_of(names, expected)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (f"rows {len(actual)} vs {len(expected)}; only Spark {sum(only_left.values())}, only SQL "
            f"{sum(only_right.values())}\n  {list(only_left)[:2]}\n  {list(only_right)[:2]}")
