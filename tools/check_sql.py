"""Compare the catalog queries with their SQL on the same parquet files.

Usage: python tools/check_sql.py [--sf DIR] [--shuffle N] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import glob
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from gridloom.catalog import all_queries, all_sql
from gridloom.core.session import build_session, use_folder


def plain(v):
    if v is None:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if type(v).__name__ == "Decimal":
        return float(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--shuffle", default="8")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": opts.shuffle,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_folder(spark, tempfile.mkdtemp(prefix="gridloom-"))
    con = duckdb.connect()
    for f in glob.glob(f"{opts.sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    queries, sql = all_queries(), all_sql()
    bad = 0
    for name, fn in queries.items():
        if opts.names and name not in opts.names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, opts.sf)
            cols, got = rows_of(df.columns, df.collect())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: {type(e).__name__} {str(e)[:1500]}")
            continue
        took = time.time() - t0
        if name not in sql:
            print(f"rows {name}: {len(got)} rows, no SQL ({took:.1f}s)")
            continue
        try:
            rel = con.execute(sql[name])
            ocols, want = rows_of([d[0] for d in rel.description], rel.fetchall())
        except Exception as e:
            bad += 1
            print(f"FAIL {name}: SQL {str(e)[:1500]}")
            continue
        if cols != ocols:
            bad += 1
            print(f"FAIL {name}: columns {cols} vs {ocols}")
        elif got != want:
            bad += 1
            diff = [(a, b) for a, b in zip(got, want) if a != b]
            extra = [r for r in got if r not in set(want)][:2] if len(got) < 50000 else []
            miss = [r for r in want if r not in set(got)][:2] if len(want) < 50000 else []
            print(f"FAIL {name}: {len(got)} vs {len(want)} rows, {len(diff)} differ\n   spark {extra}\n   sql   {miss}")
        else:
            kinds = {c: (type(a).__name__, type(b).__name__) for r, s in zip(got[:50], want[:50]) for c, a, b in zip(cols, r, s) if a is not None and type(a) is not type(b)}
            print(f"ok   {name}: {len(got)} rows ({took:.1f}s) {kinds or ''}")
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main() and 1)
