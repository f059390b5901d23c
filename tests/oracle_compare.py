"""Spark-vs-DuckDB comparison in the spirit of the driver's correctness gate.

Row count, column names (sorted) and an order-insensitive multiset of rows.
Run directly: ``python tests/oracle_compare.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "toArray"):
        return _norm(list(v.toArray()))
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name: str, sf_dir: str, fn, sql: str):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return len(s_rows), problems


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import time

    from __spark_entry__ import oracle_sql, queries
    from hourcast.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = build_session()
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        t = time.time()
        if n not in sqls:
            cnt = qs[n](spark, sf).count()
            print(f"ROWS  {n}: {cnt} rows ({time.time()-t:.1f}s)")
            continue
        try:
            cnt, probs = compare(spark, n, sf, qs[n], sqls[n])
        except Exception as e:  # noqa: BLE001
            cnt, probs = -1, [f"error {type(e).__name__}: {str(e)[:400]}"]
        bad += bool(probs)
        print(f"{'FAIL' if probs else 'OK  '}  {n}: {cnt} rows ({time.time()-t:.1f}s) {probs}")
    print("failures:", bad)
