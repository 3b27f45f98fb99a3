"""Run registered queries against DuckDB on the same parquet files: python tools/check.py [-s SF] [name ...]"""
from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

from lumenframe.plans import registry
from lumenframe.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if v is not None and type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, con, query, folder):
    t0 = time.time()
    df = query.run(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - t0
    if query.sql is None:
        return "rows-only", took, f"{len(rows)} rows {rows[:1]}"
    t0 = time.time()
    cur = con.execute(query.sql)
    cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    sql_took = time.time() - t0
    if sorted(cols) != sorted(df.columns):
        return "COLUMNS", took, f"{sorted(df.columns)} != {sorted(cols)}"
    a, b = rows_of(df.columns, rows), rows_of(cols, want)
    if a == b:
        return ("ok" if a else "EMPTY"), took, f"{len(a)} rows, sql {sql_took:.1f}s"
    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
    return "DIFF", took, f"{len(a)} vs {len(b)} rows; first {str(diff)[:900]}"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("-s", "--sf", default="0.01")
    ap.add_argument("-m", "--module")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    folder = f"/root/testdata/sf{args.sf}"
    if args.module:
        from importlib import import_module
        book = import_module(f"lumenframe.plans.{args.module}").BOOK.entries
    else:
        book = registry()
    names = args.names or list(book)
    spark = build_session("check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet')")
    bad = []
    for name in names:
        try:
            status, took, note = compare(spark, con, book[name], folder)
        except Exception as e:
            status, took, note = "ERROR", 0.0, f"{type(e).__name__}: {str(e)[:1500]}"
        if status not in ("ok", "rows-only"):
            bad.append(name)
        print(f"{status:9s} {took:6.2f}s {name}: {note if status != 'ok' else note}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
