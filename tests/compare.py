"""Run registered queries in Spark and their SQL in DuckDB, and compare all rows.

    python -m tests.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


def duck(folder: str):
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v if v is None or isinstance(v, (bool, str)) else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr), [columns[i] for i in order]


def compare(spark, con, name: str, fn, sql: str | None, folder: str):
    t0 = time.time()
    df = fn(spark, folder)
    got, cols = rows_of(df.columns, df.collect())
    took = time.time() - t0
    if sql is None:
        return True, f"{len(got)} rows, no SQL", took
    cur = con.execute(sql)
    want, want_cols = rows_of([c[0] for c in cur.description], cur.fetchall())
    if cols != want_cols:
        return False, f"columns {cols} != {want_cols}", took
    if got != want:
        a, b = set(got), set(want)
        return False, (f"{cols}\n   rows {len(got)} vs {len(want)}; only spark {list(a - b)[:3]};\n   only sql {list(b - a)[:3]}"), took
    return True, f"{len(got)} rows", took


def main(argv):
    from snapledger.queries import ORACLE, QUERIES
    from snapledger.session import local_session

    folder = argv[0] if argv and argv[0].startswith("/") else SF
    names = [a for a in argv if not a.startswith("/")] or list(QUERIES)
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), []
    for name in names:
        try:
            ok, note, took = compare(spark, con, name, QUERIES[name], ORACLE.get(name), folder)
        except Exception as e:  # noqa: BLE001
            ok, note, took = False, f"{type(e).__name__}: {str(e)[:600]}", 0
        print(f"{'ok ' if ok else 'BAD'} {name:22s} {took:6.2f}s {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(names) - len(bad)}/{len(names)} match; bad: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
