"""Side-by-side check of queries and their SQL: ``python check.py [-m module] [-s sf] [name ...]``."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import importlib
import math
import sys
import time
import traceback

import duckdb

from lexmill.plans.fixtures import TABLES
from lexmill.plans.registry import QUERIES, load_all
from lexmill.session import local_session


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("-m", "--module")
    ap.add_argument("-s", "--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    if args.module:
        importlib.import_module(f"lexmill.plans.{args.module}")
        chosen = {n: q for n, q in QUERIES.items() if q.build.__module__.endswith(args.module)}
    else:
        chosen = load_all()
    if args.names:
        chosen = {n: QUERIES[n] for n in args.names}
    sf_dir = f"/root/testdata/sf{args.sf}"
    spark = local_session()
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, q in chosen.items():
        t0 = time.time()
        try:
            df = q(spark, sf_dir)
            got = rows_of(df.columns, df.collect())
            t1 = time.time()
            if not q.sql:
                print(f"rows {name:34s} {len(got):7d} {t1 - t0:6.2f}s", flush=True)
                continue
            cur = duck.execute(q.sql)
            cols = [d[0] for d in cur.description]
            want = rows_of(cols, cur.fetchall())
            t2 = time.time()
            if sorted(cols) != sorted(df.columns):
                bad += 1
                print(f"COLS {name}: {sorted(df.columns)} vs {sorted(cols)}", flush=True)
            elif got != want:
                bad += 1
                gs, ws = set(got), set(want)
                print(f"DIFF {name}: {len(got)} vs {len(want)} rows; columns {sorted(cols)}")
                print("   spark only:", [r for r in got if r not in ws][:3])
                print("   sql only:  ", [r for r in want if r not in gs][:3], flush=True)
            else:
                flag = "ok  " if got else "ok0 "
                print(f"{flag} {name:34s} {len(got):7d} {t1 - t0:6.2f}s sql {t2 - t1:6.2f}s", flush=True)
        except Exception as exc:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"FAIL {name}: {str(exc)[:700]}", flush=True)
            if "-v" in sys.argv:
                traceback.print_exc()
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
