"""Compare a query with its oracle SQL: columns by name, rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal:{value}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([plain(r[i]) for i in order]) for r in rows))


def differences(df, con, sql) -> list[str]:
    """Empty when both sides agree."""
    cur = con.execute(sql)
    want_cols = [c[0] for c in cur.description]
    want = rows_of(want_cols, cur.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(df.columns) != sorted(want_cols):
        out.append(f"columns: {sorted(df.columns)} != {sorted(want_cols)}")
    if len(got) != len(want):
        out.append(f"rows: {len(got)} != {len(want)}")
    extra, missing = set(got) - set(want), set(want) - set(got)
    if extra or missing:
        out.append(f"{len(extra)} extra, {len(missing)} missing; {sorted(extra)[:2]} vs {sorted(missing)[:2]}")
    return out
