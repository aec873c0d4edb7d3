"""Order-insensitive comparison of a Spark result with DuckDB SQL."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else repr(f)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str):
    """(ok, message): same column names and the same multiset of rows."""
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    if sorted(df.columns) != sorted(ocols):
        return False, f"columns {sorted(df.columns)} vs {sorted(ocols)}"
    a, b = canon(df.columns, srows), canon(ocols, orows)
    if a != b:
        sa, sb = set(a), set(b)
        return False, (f"rows {len(a)} vs {len(b)}; spark-only {sorted(sa - sb)[:2]} "
                       f"oracle-only {sorted(sb - sa)[:2]}")
    return True, f"{len(a)} rows"
