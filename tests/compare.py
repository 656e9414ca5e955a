"""Spark result vs DuckDB oracle: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return v


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return ([columns[i] for i in order],
            Counter(tuple(_norm(r[i]) for i in order) for r in rows))


def compare(df, con, sql):
    """Return (ok, message)."""
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sc, sv = canon(s_cols, s_rows)
    dc, dv = canon(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} oracle={dc}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} oracle={len(d_rows)}"
    if sv != dv:
        only_s = list((sv - dv).items())[:3]
        only_d = list((dv - sv).items())[:3]
        return False, f"values differ: spark-only={only_s} oracle-only={only_d}"
    return True, f"{len(s_rows)} rows"
