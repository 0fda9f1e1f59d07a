"""Compare every registered Spark query with its DuckDB oracle.

Usage: python tests/check_oracles.py [sf_dir] [name ...]

Prints one line per query: rows on both sides, column sets and whether the
order-insensitive value multisets agree (columns sorted by name).
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def main(argv):
    sf = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as ent
    from clearbid.session import build_session
    spark = build_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, osql = ent.queries(), ent.oracle_sql()
    results = {}
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
            t1 = time.time()
            if name not in osql:
                results[name] = {"rows": len(srows), "oracle": None}
                print(f"{name:32s} spark={len(srows):7d} (no oracle) {t1 - t0:.1f}s", flush=True)
                continue
            res = con.execute(osql[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
            ok_cols = sorted(scols) == sorted(ocols)
            ok_vals = ok_cols and _rows(scols, srows) == _rows(ocols, orows)
            results[name] = {"rows": len(srows), "oracle_rows": len(orows), "cols": ok_cols, "values": ok_vals}
            flag = "OK " if ok_vals else "BAD"
            print(f"{flag} {name:32s} spark={len(srows):7d} oracle={len(orows):7d} cols={ok_cols} "
                  f"{t1 - t0:.1f}s", flush=True)
            if not ok_cols:
                print("   spark cols:", sorted(scols), "\n   oracle cols:", sorted(ocols))
            elif not ok_vals:
                a, b = _rows(scols, srows), _rows(ocols, orows)
                print("   only spark:", list((a - b).items())[:3])
                print("   only oracle:", list((b - a).items())[:3])
        except Exception as exc:  # report and continue
            results[name] = {"error": repr(exc)[:300]}
            print(f"ERR {name:32s} {type(exc).__name__}: {str(exc)[:600]}", flush=True)
    print(json.dumps({"ok": sum(1 for r in results.values() if r.get("values")), "total": len(results)}))


if __name__ == "__main__":
    main(sys.argv)
