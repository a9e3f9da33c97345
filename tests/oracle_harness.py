"""Run registered queries on Spark and their oracle SQL on DuckDB, compare.

Comparison: column names and their order, row count, and the multiset of rows
(order-insensitive); floats are compared exactly, so a mismatch in the last
bit is reported.  Usage: ``python tests/oracle_harness.py [sf_dir] [name ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from relkit.sources.tables import TABLE_NAMES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, float):
        if math.isnan(v):
            return (2, "nan")
        if v == 0.0:
            v = 0.0
        return (2, repr(v))
    if isinstance(v, int):
        return (2, repr(float(v)) if abs(v) < 2**53 else str(v))
    if isinstance(v, decimal.Decimal):
        return (3, str(v.normalize()) if v == v.to_integral() else str(v))
    if isinstance(v, dt.datetime):
        return (4, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (4, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (5, repr([_norm(x) for x in v]))
    if hasattr(v, "tolist"):
        return (5, repr([_norm(x) for x in v.tolist()]))
    return (6, str(v))


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if list(spark_cols) != list(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    if len(spark_rows) != len(duck_rows):
        return f"row count spark={len(spark_rows)} duck={len(duck_rows)}"
    a = sorted(tuple(map(_norm, r)) for r in spark_rows)
    b = sorted(tuple(map(_norm, r)) for r in duck_rows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return f"values differ, e.g. spark={x} duck={y}"
    return None


def run(sf_dir: str, names=None):
    from relkit.session import build_session
    import __spark_entry__ as entry

    if os.environ.get("RELKIT_PLAIN_SESSION"):
        # As the driver does: a bare session with Spark's defaults.
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session(shuffle_partitions=8)
    qs = entry.queries()
    oracles = entry.oracle_sql()
    con = duck(sf_dir)
    failures = []
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
            if name not in oracles:
                print(f"ROWS  {name:32s} {len(rows):7d} rows  {time.time() - t0:6.2f}s (no oracle)")
                continue
            res = con.execute(oracles[name])
            drows = res.fetchall()
            dcols = [c[0] for c in res.description]
            err = compare(rows, cols, drows, dcols)
        except Exception as exc:  # noqa: BLE001
            err = f"ERROR {type(exc).__name__}: {str(exc)[:400]}"
            traceback.print_exc(limit=2)
        status = "OK   " if err is None else "FAIL "
        print(f"{status} {name:32s} {len(rows) if err is None else '':>7} {time.time() - t0:6.2f}s {err or ''}",
              flush=True)
        if err:
            failures.append((name, err))
    print(f"\n{len(failures)} failures")
    return failures


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf, args = args[0], args[1:]
    run(sf, args or None)
