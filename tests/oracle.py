"""Runs a registered query and its SQL side by side and compares the rows."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    return con


def plain(value):
    """One form per value, whichever engine it came from."""
    if value is None:
        return None
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in sorted(value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def kinds(row) -> tuple:
    return tuple(type(v).__name__ for v in row)


def ordered(columns: list[str], rows) -> list[tuple]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in at) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = result.fetchall()
    mine = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(set(df.columns) ^ set(columns))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} against {len(theirs)}"
    a, b = ordered(df.columns, mine), ordered(columns, theirs)
    names = sorted(columns)
    for x, y in zip(a, b):
        if x != y:
            bad = [(n, p, q) for n, p, q in zip(names, x, y) if p != q or type(p) is not type(q)]
            return f"differs at {bad[:4]}"
        if kinds(x) != kinds(y):
            return f"types {[(n, type(p), type(q)) for n, p, q in zip(names, x, y) if type(p) is not type(q)]}"
    return None
