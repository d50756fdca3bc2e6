"""Run a query and its SQL on the same tables and compare them as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Row count and a description of the first difference, if any."""
    result = con.execute(sql)
    sql_columns = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    if sorted(df.columns) != sorted(sql_columns):
        return 0, f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    expected = _rows(sql_columns, expected_rows)
    n = sum(expected.values())
    if actual == expected:
        return n, None
    missing, extra = expected - actual, actual - expected
    return n, (
        f"{sum(actual.values())} rows for {n}; missing {sum(missing.values())} "
        f"{list(missing)[:2]}; extra {sum(extra.values())} {list(extra)[:2]}"
    )
