"""Run every registered query in Spark and its oracle in DuckDB; compare.

    python tests/check_oracles.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (exact values;
float-only differences are reported separately).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v, digits: int | None = None):
    if isinstance(v, float):
        return round(v, digits) if digits is not None else v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, digits)) for k, x in v.items()))
    if isinstance(v, decimal.Decimal):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "asDict"):
        return norm(v.asDict(), digits)
    return v


def rows_of(cols, rows, order, digits=None):
    idx = [cols.index(c) for c in order]
    return Counter(tuple(norm(r[i], digits) for i in idx) for r in rows)


def compare(spark_cols, spark_rows, duck_cols, duck_rows):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark {sorted(spark_cols)} duck {sorted(duck_cols)}"
    if len(spark_rows) != len(duck_rows):
        return f"row count {len(spark_rows)} vs {len(duck_rows)}"
    order = sorted(spark_cols)
    a, b = rows_of(spark_cols, spark_rows, order), rows_of(duck_cols, duck_rows, order)
    if a == b:
        return None
    a9, b9 = rows_of(spark_cols, spark_rows, order, 9), rows_of(duck_cols, duck_rows, order, 9)
    diff_a, diff_b = a - b, b - a
    sample = f"spark-only {list(diff_a.items())[:2]} duck-only {list(diff_b.items())[:2]}"
    if a9 == b9:
        return "float-only difference: " + sample
    return "values differ: " + sample


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    import __spark_entry__ as entry
    if os.environ.get("PLAIN_SESSION"):
        # A session with Spark's defaults, as another program would build it.
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        from martline.session import build_session
        spark = build_session("local[8]", 8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_rows = [tuple(r) for r in df.collect()]
            s_cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in sqls:
            print(f"NOSQL {name}: {len(s_rows)} rows ({t1 - t0:.1f}s)")
            continue
        try:
            res = con.execute(sqls[name])
            d_cols = [d[0] for d in res.description]
            d_rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        msg = compare(s_cols, s_rows, d_cols, d_rows)
        if msg:
            bad += 1
            print(f"FAIL {name}: {msg}")
        else:
            print(f"ok   {name}: {len(s_rows)} rows (spark {t1 - t0:.1f}s)")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
