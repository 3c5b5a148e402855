"""Compare a Spark result with its checking SQL run by DuckDB: columns, rows, values."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from decimal import Decimal

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (int, float, Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else float(f"{v:.12g}") + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """Empty when the two results are equal."""
    ran = con.execute(sql)
    want_names = [d[0] for d in ran.description]
    want = _rows(want_names, ran.fetchall())
    got = _rows(df.columns, df.collect())
    if sorted(want_names) != sorted(df.columns):
        extra = set(df.columns) - set(want_names)
        return [f"columns differ: only Spark {sorted(extra)}, only SQL {sorted(set(want_names) - set(df.columns))}"]
    if len(got) != len(want):
        return [f"{len(got)} rows, expected {len(want)}"]
    names = sorted(want_names)
    out = []
    for g, w in zip(got, want):
        if g != w:
            out.append(str({n: (a, b) for n, a, b in zip(names, g, w) if a != b}))
    return out[:5] + ([f"... {len(out)} rows differ"] if len(out) > 5 else [])
