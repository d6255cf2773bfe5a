"""Compare every registered Spark query with its DuckDB oracle.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]

Prints one line per query: row counts, column-name match and whether the
order-insensitive multiset of rows is equal (floats compared at 9
significant digits, timestamps as naive values).
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def normalize(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as se
    qs, oracles = se.queries(), se.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
        except Exception as exc:  # report and go on with the next query
            results[name] = dict(ok=False, error=str(exc)[:300])
            print(f"ERR {name:28s} {str(exc)[:300]}", flush=True)
            continue
        cols = df.columns
        secs = time.time() - t0
        if name not in oracles:
            results[name] = dict(rows=len(rows), oracle=None, ok=None, secs=secs)
            if verbose:
                print(f"{name:28s} spark={len(rows):7d} (no oracle) {secs:.1f}s", flush=True)
            continue
        cur = con.execute(oracles[name])
        ocols = [d[0] for d in cur.description]
        orows = cur.fetchall()
        same_cols = sorted(cols) == sorted(ocols)
        same = same_cols and normalize(rows, cols) == normalize(orows, ocols)
        results[name] = dict(rows=len(rows), oracle=len(orows), cols=same_cols, ok=same, secs=secs)
        if verbose:
            flag = "OK " if same else "BAD"
            print(f"{flag} {name:28s} spark={len(rows):7d} duck={len(orows):7d} cols={same_cols} {secs:.1f}s",
                  flush=True)
            if not same_cols:
                print("    spark cols:", sorted(cols), "\n    duck cols: ", sorted(ocols))
            elif not same:
                a, b = normalize(rows, cols), normalize(orows, ocols)
                sa, sb = set(a), set(b)
                print("    only spark:", list(sa - sb)[:3], "\n    only duck: ", list(sb - sa)[:3])
    return results


if __name__ == "__main__":
    from contract_lake.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v["ok"] is False]
    print("mismatches:", bad)
