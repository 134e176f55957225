"""Run registered Spark queries and their DuckDB oracle side by side.

usage: python scripts/oracle_check.py [sf_dir] [key,key,...]
Compares row count, column names and order-insensitive values (floats rounded).
"""
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])
from tally.plans.registry import oracle_sql, spark_callables  # noqa: E402
from tally.session import get_spark  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
BAD_DUCK_TYPES = ("DECIMAL", "INTEGER", "DATE", "INTERVAL", "SMALLINT", "HUGEINT")


def norm_value(x):
    if x is None:
        return "∅"
    if isinstance(x, float):
        if math.isnan(x):
            return "∅"
        return f"{x:.6g}" if abs(x) >= 1e15 else f"{round(x, 6):.6f}"
    if isinstance(x, bool):
        return str(x)
    if hasattr(x, "isoformat"):
        return x.isoformat(sep=" ") if hasattr(x, "hour") else x.isoformat()
    return str(x)


def norm(rows, cols, order):
    idx = [cols.index(c) for c in order]
    return sorted(tuple(norm_value(r[i]) for i in idx) for r in rows)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 and sys.argv[2] else None
    spark = get_spark("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = spark_callables(), oracle_sql()
    keys = only or list(qs)
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = qs[k](spark, sf)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
            st = time.time() - t0
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        if k not in sqls:
            print(f"{k:32s} rows={len(srows):7d} (no oracle) {st:.1f}s")
            continue
        try:
            rel = con.execute(sqls[k])
            dcols = [d[0] for d in rel.description]
            dtypes = [str(d[1]) for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:32s} DUCK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        order = sorted(scols)
        if sorted(dcols) != order:
            print(f"{k:32s} COLUMNS spark={sorted(scols)} duck={sorted(dcols)}")
            bad += 1
            continue
        a, b = norm(srows, scols, order), norm(drows, dcols, order)
        warn = [f"{c}:{t}" for c, t in zip(dcols, dtypes) if t.startswith(BAD_DUCK_TYPES)]
        ok = a == b
        bad += not ok
        print(f"{k:32s} rows={len(srows):7d}/{len(drows):7d} {'OK' if ok else 'MISMATCH'} {st:.1f}s"
              + (f" duck-types={warn}" if warn else ""))
        if not ok:
            sa, sb = set(a), set(b)
            print("   cols", order)
            print("   spark-only", len(sa - sb), sorted(sa - sb)[:2])
            print("   duck-only ", len(sb - sa), sorted(sb - sa)[:2])
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
