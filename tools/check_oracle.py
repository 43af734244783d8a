"""Run registered queries next to their SQL in an in-process DuckDB and compare rows, columns and values.

    python tools/check_oracle.py [--sf 0.01] [--data /root/testdata] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from tablestream.plans.registry import load_all  # noqa: E402
from tablestream.session import get_spark  # noqa: E402


def norm(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool) or type(v).__name__ == "bool_":
        return bool(v)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    if type(v).__name__ in ("Decimal",) or isinstance(v, float) or type(v).__name__.startswith("float"):
        return float(v)
    if hasattr(v, "item"):
        return v.item()
    return v


# column types the two engines spell differently
TYPES = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--data", default="/root/testdata")
    ap.add_argument("--hot-rows", help="rows from which a key counts as hot (small values force the chunked plans)")
    ap.add_argument("--skip", default="", help="comma-separated name parts to leave out")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    folder = f"{a.data}/sf{a.sf}"
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    if a.hot_rows:
        spark.conf.set("spark.tablestream.hotKeyRows", a.hot_rows)
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    bad = 0
    for name, q in load_all().items():
        if a.names and not any(name.startswith(p) for p in a.names):
            continue
        if any(x and x in name for x in a.skip.split(",")):
            continue
        t0 = time.time()
        try:
            df = q(spark, folder)
            cols = sorted(df.columns)
            got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
            sec = time.time() - t0
            if q.sql is None:
                print(f"rows  {name:32s} {len(got):7d} rows {sec:5.1f}s")
                continue
            rel = con.execute(q.sql)
            names = [d[0] for d in rel.description]
            rows = rel.fetchall()
            idx = [names.index(c) for c in sorted(names)]
            want = [tuple(norm(r[i]) for i in idx) for r in rows]
            key = lambda r: tuple((x is None, str(x)) for x in r)
            ok = sorted(names) == cols and sorted(got, key=key) == sorted(want, key=key)
            duck = {r[0]: r[1] for r in con.execute(f"describe {q.sql}").fetchall()} if ok else {}
            types = {c: (t, duck.get(c)) for c, t in df.dtypes if duck and TYPES.get(t, t.upper()) != duck.get(c)}
            print(f"{'ok   ' if ok else 'DIFF '} {name:32s} {len(got):7d} rows {sec:5.1f}s {types or ''}")
            if not ok:
                bad += 1
                print("   columns", cols, sorted(names), "rows", len(got), len(want))
                gs, ws = set(got), set(want)
                print("   only spark ", sorted(gs - ws, key=key)[:3])
                print("   only duckdb", sorted(ws - gs, key=key)[:3])
        except Exception as e:  # noqa: BLE001 - report and go on with the next query
            bad += 1
            print(f"FAIL  {name:32s} {type(e).__name__}: {str(e)[:700]}")
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
