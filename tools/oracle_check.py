"""Run every registered query in Spark and its oracle SQL in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [key ...]
Compares column names, row counts and the sorted multiset of normalised rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, ".")

from tablewatch.plans import load_all  # noqa: E402
from tablewatch.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: repr(r))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    queries, oracle = load_all()
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    ok = bad = 0
    for key, fn in queries.items():
        if only and key not in only:
            continue
        try:
            t0 = time.time()
            df = fn(spark, sf_dir)
            srows = df.collect()
            snames = df.columns
            st = time.time() - t0
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-ERROR {key}: {e}".splitlines()[0][:300])
            traceback.print_exc(limit=2)
            bad += 1
            continue
        if key not in oracle:
            print(f"rows-only  {key}: {len(srows)} rows ({st:.2f}s)")
            continue
        try:
            cur = con.execute(oracle[key])
            dnames = [d[0] for d in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"DUCK-ERROR {key}: {str(e)[:400]}")
            bad += 1
            continue
        a, b = rows_of(snames, srows), rows_of(dnames, drows)
        if sorted(snames) != sorted(dnames):
            print(f"COLS-DIFF  {key}: spark={sorted(snames)} duck={sorted(dnames)}")
            bad += 1
        elif a != b:
            sa, sb = set(a), set(b)
            print(f"VALUE-DIFF {key}: spark={len(a)} duck={len(b)} only_spark={list(sa - sb)[:3]} "
                  f"only_duck={list(sb - sa)[:3]}")
            bad += 1
        else:
            ok += 1
            print(f"ok         {key}: {len(a)} rows ({st:.2f}s)")
    print(f"== {ok} ok, {bad} bad")


if __name__ == "__main__":
    main()
