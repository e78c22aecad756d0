"""Spark-vs-DuckDB comparison in the style of the driver's correctness gate."""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os

import duckdb

from stockflow.sources.tables import TABLES


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        r = round(v, digits)
        return repr(0.0 if r == 0 else r)
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), digits)
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return repr([_norm(x, digits) for x in v])
    if isinstance(v, dict):
        return repr({k: _norm(x, digits) for k, x in sorted(v.items())})
    return str(v)


def _rows_key(r):
    return tuple("" if x is None else "1" + x for x in r)


def compare(spark_df, con, sql: str, digits: int = 6):
    """Return (ok, message)."""
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    order = sorted(s_cols)
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sn = sorted((tuple(_norm(r[i], digits) for i in si) for r in s_rows), key=_rows_key)
    dn = sorted((tuple(_norm(r[i], digits) for i in di) for r in d_rows), key=_rows_key)
    if len(sn) != len(dn):
        return False, f"row count spark={len(sn)} duck={len(dn)}"
    for a, b in zip(sn, dn):
        if a != b:
            return False, f"first diff cols={order}\n spark={a}\n duck ={b}"
    return True, f"{len(sn)} rows"
