"""Run a registered query on Spark and its oracle SQL on DuckDB; compare results.

Row count, column names, column types (Spark type mapped to DuckDB's) and the
multiset of rows (order-insensitive) must all be equal. Usable as a script: ``python tests/oracle_compare.py [sf_dir] [names...]``.
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
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    if isinstance(v, (list, tuple, set)):
        return repr(sorted(map(str, v)))
    return repr(v) if not isinstance(v, str) else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    spark_to_duck = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                     "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    d_types = {c[0]: str(c[1]) for c in res.description}
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark-only={sorted(set(s_cols)-set(d_cols))} " \
                      f"duck-only={sorted(set(d_cols)-set(s_cols))}"
    try:
        typed = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    except Exception:  # DESCRIBE of a complex query may fail; fall back to the cursor types
        typed = d_types
    wrong = {c: (t, typed.get(c)) for c, t in df.dtypes if spark_to_duck.get(t, t) != typed.get(c)}
    if wrong:
        return False, f"types differ: {wrong}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ ({sum(1 for x, y in zip(a, b) if x != y)} rows), e.g. {diff}"
    return True, f"{len(s_rows)} rows"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from strata.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(oracle_sql())
    spark = build_session("local[8]")
    con = duck(sf)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf, n, queries()[n], oracle_sql()[n], con)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")
