"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as e
    qs, oracle = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in sdf.collect()]
            scols = sdf.columns
        except Exception as ex:  # noqa: BLE001
            results[name] = ("spark-error", repr(ex)[:300])
            if verbose:
                print(f"{name:28s} SPARK ERROR {ex!r}"[:400])
            continue
        if name not in oracle:
            results[name] = ("rows-only", len(srows))
            if verbose:
                print(f"{name:28s} rows-only {len(srows)} ({time.time() - t0:.1f}s)")
            continue
        try:
            cur = con.execute(oracle[name])
            dcols = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as ex:  # noqa: BLE001
            results[name] = ("duck-error", repr(ex)[:300])
            if verbose:
                print(f"{name:28s} DUCKDB ERROR {ex!r}"[:400])
            continue
        ok_cols = sorted(scols) == sorted(dcols)
        a, b = _rows(scols, srows), _rows(dcols, drows)
        ok = ok_cols and a == b
        results[name] = ("ok" if ok else "MISMATCH", len(srows), len(drows))
        if verbose:
            msg = f"{name:28s} {'ok' if ok else 'MISMATCH'} spark={len(srows)} duck={len(drows)} ({time.time() - t0:.1f}s)"
            if not ok_cols:
                msg += f"\n   cols spark={sorted(scols)}\n        duck={sorted(dcols)}"
            elif not ok:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msg += f"\n   first diffs: {diff}"
            print(msg)
    return results


if __name__ == "__main__":
    from carepath.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_session("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = {k: v for k, v in res.items() if v[0] not in ("ok", "rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} fine; bad: {sorted(bad)}")
