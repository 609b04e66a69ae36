"""Run registered queries on Spark and their SQL oracle on DuckDB and compare.

Usage: python tools/oracle_check.py [sf_dir] [name-substring ...]

Columns are compared by name (sorted), rows as an order-insensitive
multiset of exact Python values.  Exit code 1 on any mismatch.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerloom.catalog import load_all  # noqa: E402
from ledgerloom.session import build_session  # noqa: E402
from ledgerloom.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


EXACT = os.environ.get("ORACLE_EXACT", "0") == "1"


def norm(v):
    if isinstance(v, float) and not EXACT:
        return round(v, 9)
    return v


def compare(spark, con, q, sf_dir, verbose=True):
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(q.sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only={sorted(set(s_cols) - set(d_cols))} "
                        f"oracle-only={sorted(set(d_cols) - set(s_cols))}")
    else:
        order = sorted(s_cols)
        si = [s_cols.index(c) for c in order]
        di = [d_cols.index(c) for c in order]
        sc = Counter(tuple(norm(r[i]) for i in si) for r in s_rows)
        dc = Counter(tuple(norm(r[i]) for i in di) for r in d_rows)
        if len(s_rows) != len(d_rows):
            problems.append(f"row count spark={len(s_rows)} oracle={len(d_rows)}")
        if sc != dc:
            only_s = list((sc - dc).elements())[:3]
            only_d = list((dc - sc).elements())[:3]
            # locate differing columns on the first pair
            if only_s and only_d:
                diffs = [(order[k], only_s[0][k], only_d[0][k]) for k in range(len(order))
                         if only_s[0][k] != only_d[0][k]]
                problems.append(f"values differ e.g. {diffs[:6]}")
            problems.append(f"{sum((sc - dc).values())} spark-only rows, {sum((dc - sc).values())} oracle-only rows")
        # type check on first non-null values
        for k, c in enumerate(order):
            sv = next((r[si[k]] for r in s_rows if r[si[k]] is not None), None)
            dv = next((r[di[k]] for r in d_rows if r[di[k]] is not None), None)
            if sv is not None and dv is not None and type(sv) is not type(dv):
                problems.append(f"type {c}: {type(sv).__name__} vs {type(dv).__name__}")
    status = "OK " if not problems else "BAD"
    if verbose:
        print(f"{status} {q.name:55s} rows={len(s_rows):7d} spark={t1 - t0:6.2f}s duck={t2 - t1:5.2f}s", flush=True)
        for p in problems:
            print("     ", p, flush=True)
    return not problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    pats = [a for a in argv[1:] if not a.startswith("/")]
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    reg = load_all()
    ok = True
    for name, q in reg.items():
        if pats and not any(p in name for p in pats):
            continue
        if q.sql is None:
            continue
        try:
            ok &= compare(spark, con, q, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok = False
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:800]}", flush=True)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
