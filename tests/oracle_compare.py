"""Run registered queries against their DuckDB oracle and compare.

Comparison mirrors the driver's: column names sorted, row count, and an
order-insensitive multiset of normalised row tuples.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(type(x)), x) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    sc, dc = sorted(spark_cols), sorted(duck_cols)
    if sc != dc:
        return False, f"columns differ: spark={sc} oracle={dc}"
    si = [spark_cols.index(c) for c in sc]
    di = [duck_cols.index(c) for c in dc]
    for c, i, j in zip(sc, si, di):     # same Python value types per column (None aside)
        ts = {type(r[i]).__name__ for r in spark_rows if r[i] is not None}
        td = {type(r[j]).__name__ for r in duck_rows if r[j] is not None}
        if ts and td and ts != td:
            return False, f"column {c}: spark types {ts} oracle types {td}"
    a = sorted((tuple(_norm(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} oracle={len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. spark={bad[0][0]} oracle={bad[0][1]}"
    return True, f"{len(a)} rows"


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from stagewise.session import local_session
    spark = local_session()
    con = duck(sf_dir)
    qs, oracle = E.queries(), E.oracle_sql()
    failures = 0
    for name, q in qs.items():
        if only and name not in only:
            continue
        t = time.time()
        df = q(spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        ts = time.time() - t
        if name not in oracle:
            print(f"{name:28s} NO-ORACLE rows={len(rows)} spark={ts:.1f}s")
            continue
        t = time.time()
        res = con.execute(oracle[name])
        drows = res.fetchall()
        dcols = [d[0] for d in res.description]
        td = time.time() - t
        ok, msg = compare(rows, df.columns, drows, dcols)
        failures += not ok
        print(f"{name:28s} {'OK  ' if ok else 'FAIL'} {msg} spark={ts:.1f}s duck={td:.1f}s", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
