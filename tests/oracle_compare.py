"""Run registered queries with Spark and their SQL with DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Compares column names (sorted), row counts and the multiset of rows
(floats rounded to 6 places, timestamps as naive datetimes).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
                 "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def type_diffs(spark_dtypes, duck_desc):
    d = {c[0]: str(c[1]) for c in duck_desc}
    out = []
    for name, t in spark_dtypes:
        want = SPARK_TO_DUCK.get(t, t)
        if name in d and d[name] != want:
            out.append((name, t, d[name]))
    return out


def compare(spark, sf, names, queries, sql, check_types=True):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = []
    for n in names:
        t0 = time.time()
        try:
            df = queries[n](spark, sf)
            s_cols = df.columns
            s_types = df.dtypes
            s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad.append(n)
            continue
        t1 = time.time()
        if n not in sql:
            print(f"{n:28s} rows={len(s_rows):6d} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sql[n])
            d_cols = [c[0] for c in res.description]
            d_rows = rows_of(d_cols, res.fetchall())
        except Exception as e:  # noqa: BLE001
            print(f"{n:28s} SQL ERROR {str(e)[:300]}")
            bad.append(n)
            continue
        ok_cols = sorted(s_cols) == sorted(d_cols)
        ok_rows = Counter(s_rows) == Counter(d_rows)
        tdiff = type_diffs(s_types, res.description) if check_types else []
        status = "OK" if ok_cols and ok_rows and not tdiff else "MISMATCH"
        if tdiff:
            print("   types (col, spark, duckdb):", tdiff)
        print(f"{n:28s} {status} rows spark={len(s_rows)} sql={len(d_rows)} "
              f"{t1 - t0:.1f}s")
        if not ok_cols:
            print("   cols", sorted(s_cols), sorted(d_cols))
        elif not ok_rows:
            a, b = Counter(s_rows), Counter(d_rows)
            print("   spark-only", list((a - b).elements())[:2])
            print("   sql-only  ", list((b - a).elements())[:2])
        if status != "OK":
            bad.append(n)
    return bad


if __name__ == "__main__":
    from tidewatch.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    q, s = E.queries(), E.oracle_sql()
    names = sys.argv[2:] or sorted(q)
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    bad = compare(spark, sf, names, q, s)
    print("FAILED:", bad)
