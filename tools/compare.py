"""Run registered queries next to their SQL in DuckDB and report differences.

usage: python tools/compare.py [--sf DIR] [query ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    return value


def ordered(rows):
    return sorted((tuple(canonical(v) for v in r) for r in rows), key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def compare(df, con, sql: str) -> str:
    """Empty text when both sides hold the same rows, else the first difference."""
    names = sorted(df.columns)
    rows = ordered(tuple(r[n] for n in names) for r in df.collect())
    cur = con.execute(sql)
    theirs = [d[0] for d in cur.description]
    if sorted(theirs) != names:
        return f"columns {names} != {sorted(theirs)}"
    index = [theirs.index(n) for n in names]
    expected = ordered(tuple(r[i] for i in index) for r in cur.fetchall())
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for x, y in zip(rows, expected):
        for n, v, w in zip(names, x, y):
            if v != w or type(v) is not type(w):
                bad = sum(p != q for p, q in zip(rows, expected))
                return f"{bad} rows differ, first at {n}: {v!r} ({type(v).__name__}) != {w!r} ({type(w).__name__})\n   {x}\n   {y}"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from uptide.plans.catalog import QUERIES, SQL
    from uptide.session import local_session

    spark = local_session(8)
    con = connect(args.sf)
    failed = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            problem = compare(df, con, SQL[name]) if name in SQL else f"(no SQL, {df.count()} rows)"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = not problem or problem.startswith("(no SQL")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {problem}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main())
