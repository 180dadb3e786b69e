"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

usage: python scripts/oracle_check.py [SF_DIR] [name ...]

Comparison: row count, column names (sorted), and the multiset of rows with
columns in name order. Values are compared exactly; a second pass with a
1e-9 relative tolerance on floats is reported separately.
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from strata.session import build_session  # noqa: E402
from strata.tables import TABLES  # noqa: E402


def norm(v, tol):
    if v is None:
        return ("null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, tol) if tol is not None else v
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item(), tol)
        except Exception:
            pass
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(records, cols, tol):
    out = []
    for rec in records:
        out.append(tuple(norm(rec[c], tol) for c in cols))
    return sorted(out, key=repr)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from strata.plans.registry import ORACLE, QUERIES

    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    ok = bad = 0
    for name in names or list(QUERIES):
        t0 = time.time()
        try:
            sdf = QUERIES[name](spark, sf_dir)
            srows = [r.asDict() for r in sdf.collect()]
            scols = sorted(sdf.columns)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLE.get(name)
        if sql is None:
            print(f"rows {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            cur = con.execute(sql)
            dcols = [d[0] for d in cur.description]
            drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(dcols) != scols:
            print(f"FAIL {name}: columns spark={scols} duck={sorted(dcols)}")
            bad += 1
            continue
        if len(srows) != len(drows):
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)}")
            bad += 1
            continue
        a, b = rows_of(srows, scols, None), rows_of(drows, scols, None)
        if a == b:
            print(f"ok   {name}: {len(srows)} rows {ts:.1f}s")
            ok += 1
            continue
        a9, b9 = rows_of(srows, scols, 9), rows_of(drows, scols, 9)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        tag = "TOLR" if a9 == b9 else "FAIL"
        print(f"{tag} {name}: values differ; cols={scols}; e.g. {diff}")
        bad += 1
    print(f"{ok} ok, {bad} not ok")
    spark.stop()


if __name__ == "__main__":
    main()
