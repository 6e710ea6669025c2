"""Run registered queries in Spark and their SQL oracle in DuckDB and compare
row count, column names/types and the multiset of values.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402
from ledgerlens.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def canon(rows):
    return sorted((tuple(norm(x) for x in r) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    spark = build_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERR {str(e).splitlines()[0][:300]}")
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:28s} rows={len(srows):7d} spark={ts:5.1f}s  (no oracle)")
            continue
        try:
            rel = con.sql(sqls[name])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} SQL-ERR {str(e).splitlines()[0][:300]}")
            continue
        dcols = rel.columns
        drows = rel.fetchall()
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        dorder = sorted(range(len(dcols)), key=lambda i: dcols[i])
        ok_cols = sorted(cols) == sorted(dcols)
        s = canon([tuple(r[i] for i in order) for r in srows])
        d = canon([tuple(r[i] for i in dorder) for r in drows]) if ok_cols else []
        ok = ok_cols and s == d
        stypes = dict(df.dtypes)
        dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
        status = "OK " if ok else "BAD"
        bad += not ok
        print(f"{name:28s} {status} rows={len(srows):7d}/{len(drows):7d} spark={ts:5.1f}s")
        if not ok:
            if not ok_cols:
                print("   cols spark:", cols, "\n   cols duck :", dcols)
            else:
                ss, dd = set(s), set(d)
                print("   only spark:", list(ss - dd)[:3])
                print("   only duck :", list(dd - ss)[:3])
        print("   types:", {c: (stypes[c], dtypes.get(c)) for c in cols})
    print("BAD:", bad)


if __name__ == "__main__":
    main()
