"""Runs registered queries against their SQL counterparts: python tests/compare.py [sf] [name ...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, sql: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else f"{v:.6f}".replace("-0.000000", "0.000000")
        return "" if v is None else str(v)

    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def difference(spark, name, sf_dir, query, sql) -> str | None:
    """None when both sides agree, else what differs."""
    frame = query(spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = canonical(*sql_rows(sf_dir, sql))
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1]) if a != b]
    return f"{len(wrong)} of {len(ours[1])} rows differ, e.g. {wrong[0]}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from supplyloom.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:]
    spark = local_session()
    sf_dir = f"/root/testdata/sf{sf}"
    oracle = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracle:
                found = difference(spark, name, sf_dir, query, oracle[name])
            else:
                found = None if query(spark, sf_dir).collect() else "no rows"
        except Exception as e:  # report and go on
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        kind = "sql" if name in oracle else "rows"
        print(f"{'FAIL' if found else 'ok  '} {name} [{kind}] {time.time() - start:.1f}s {found or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
