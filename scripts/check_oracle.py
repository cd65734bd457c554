"""Run every named query in Spark and its SQL oracle in DuckDB; compare.

usage: python scripts/check_oracle.py [sf_dir] [name ...]

Prints one line per query: rows, column names, and whether the order-
insensitive multiset of rows matches (floats compared at 9 significant digits).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from listenlens.plans import all_queries  # noqa: E402
from listenlens.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm_value(x) for x in v)
    if hasattr(v, "item"):
        return norm_value(v.item())
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm_value(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    spark = get_spark(os.environ.get("ORACLE_MASTER", "local[8]"), 8, extra={"spark.ui.showConsoleProgress": "false"})
    bad = 0
    for name, q in all_queries().items():
        if only and name not in only:
            continue
        t0 = time.time()
        try:
            df = q.build(spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # report and continue
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"{name:28s} rows={len(rows):7d} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(q.sql)
            ocols = rel.columns
            orows = rel.fetchall()
        except Exception as e:
            print(f"{name:28s} SQL-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        same_cols = sorted(cols) == sorted(ocols)
        same = same_cols and canon(rows, cols) == canon(orows, ocols)
        flag = "OK " if same else "BAD"
        if not same:
            bad += 1
        print(f"{name:28s} {flag} rows={len(rows):7d}/{len(orows):7d} cols_match={same_cols} {ts:.1f}s")
        if not same and same_cols:
            a, b = canon(rows, cols), canon(orows, ocols)
            sa, sb = set(a), set(b)
            print("   spark-only:", list(sa - sb)[:3])
            print("   oracle-only:", list(sb - sa)[:3])
        elif not same_cols:
            print("   spark cols:", cols, " oracle cols:", ocols)
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
