"""Run a named query on Spark and its SQL on DuckDB; compare names, counts and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    """One spelling per value; numbers of different width compare equal, types do not."""
    if v is None:
        return None
    if isinstance(v, bool):
        return ("bool", v)
    if isinstance(v, int):
        return ("int", v)
    if isinstance(v, float):
        return ("float", "nan" if math.isnan(v) else repr(v))
    if isinstance(v, decimal.Decimal):
        return ("decimal", str(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return (type(v).__name__, v.isoformat())
    return (type(v).__name__, v)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str | None]:
    """(row count, first difference or None)."""
    got_rows = [tuple(r) for r in df.collect()]
    got = _rows(df.columns, got_rows)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = _rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            cols = sorted(names)
            diffs = [(c, a, b) for c, a, b in zip(cols, g, w) if a != b]
            return len(got), f"value {str(diffs)[:600]}"
    return len(got), None
