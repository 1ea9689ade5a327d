"""Shared test helpers: DuckDB over the test parquet, row normalization."""

from __future__ import annotations

import decimal
from pathlib import Path

import duckdb

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "\0"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.6f}"
    return str(v)


def spark_rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())


def duck_rows(con, sql, cols):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return sorted(tuple(norm(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
