"""Side-by-side check of ``queries()`` against ``oracle_sql()`` on DuckDB.

Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``. Compares row
count, column names and an order-insensitive hash of the values, the same
three things the round checker records; floats are compared exactly first
and, if that fails, within 1e-9 relative to tell rounding noise apart.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if exact else f"{v:.9g}"
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, exact) for x in v)
    return v


def _digest(rows, exact: bool) -> str:
    keyed = sorted(repr(tuple(_norm(v, exact) for v in r)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()


def compare(spark, name: str, sf_dir: str) -> dict:
    import __spark_entry__ as entry

    t0 = time.time()
    sdf = entry.queries()[name](spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    out["plan"] = sdf._jdf.queryExecution().executedPlan().toString()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        out["status"] = "rows-only"
        return out
    rel = duck(sf_dir).execute(sql)
    d_cols = [c[0] for c in rel.description]
    d_rows = [tuple(r) for r in rel.fetchall()]
    out["oracle_rows"] = len(d_rows)
    order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    s_sorted = [tuple(r[i] for i in order_s) for r in s_rows]
    d_sorted = [tuple(r[i] for i in order_d) for r in d_rows]
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["exact_match"] = out["columns_match"] and _digest(s_sorted, True) == _digest(d_sorted, True)
    out["close_match"] = out["columns_match"] and _digest(s_sorted, False) == _digest(d_sorted, False)
    ok = out["columns_match"] and len(s_rows) == len(d_rows) and out["exact_match"]
    out["status"] = "ok" if ok else "MISMATCH"
    if not out["columns_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
    elif not ok:
        ss = set(repr(tuple(_norm(v, True) for v in r)) for r in s_sorted)
        dd = set(repr(tuple(_norm(v, True) for v in r)) for r in d_sorted)
        out["only_spark"] = sorted(ss - dd)[:3]
        out["only_oracle"] = sorted(dd - ss)[:3]
    return out


def main(argv):
    from revcast.session import build_session
    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    spark = build_session()
    bad = 0
    for name in names:
        try:
            res = compare(spark, name, sf_dir)
        except Exception as exc:  # report and continue
            res = {"name": name, "status": "ERROR", "error": str(exc).splitlines()[0][:300]}
        if res["status"] not in ("ok", "rows-only"):
            bad += 1
        print({k: v for k, v in res.items() if k != "plan"}, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
