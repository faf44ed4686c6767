"""Run queries next to their SQL: ``python -m checks.compare DIR [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from datetime import date, datetime

import duckdb

from checks.oracles import ORACLES
from checks.queries import all_queries


def duck(sf: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (datetime, date)):
        return str(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(shaped, key=repr)


def compare(spark, con, sf: str, name: str) -> tuple[str, int, float]:
    began = time.time()
    df = all_queries()[name](spark, sf)
    got_cols, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spent = time.time() - began
    if name not in ORACLES:
        return "rows only", len(got), spent
    cur = con.execute(ORACLES[name])
    want_cols, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} <> {want_cols}", len(got), spent
    if got != want:
        extra = next((x for x in zip(got, want) if x[0] != x[1]), None)
        return f"values differ ({len(got)} / {len(want)} rows): {str(extra)[:600]}", len(got), spent
    types = dict(df.dtypes)
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    return "ok " + ", ".join(f"{k}:{types[k]}/{sql_types[k]}" for k in sorted(types)), len(got), spent


def main(argv: list[str]) -> int:
    from feedloom.session import local_session
    sf, names = argv[0], argv[1:] or list(all_queries())
    spark, con, failed = local_session("compare"), duck(sf), 0
    for name in names:
        try:
            verdict, n, spent = compare(spark, con, sf, name)
        except Exception as error:  # report and go on with the next query
            verdict, n, spent = f"error {type(error).__name__}: {str(error)[:700]}", 0, 0.0
        bad = not verdict.startswith(("ok", "rows only"))
        failed += bad
        print(f"{'FAIL' if bad else 'pass'} {name:24s} {n:8d} {spent:6.2f}s {verdict}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
