"""Run registered queries on Spark and their SQL on DuckDB and compare every value exactly.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set threads=8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def rows_of(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data), sorted(names)


def compare(spark, con, sf, name, query, sql):
    start = time.time()
    df = query(spark, sf)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if sql is None:
        return ("rows", len(got), spent, "")
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    a, an = rows_of(df.columns, got)
    b, bn = rows_of(want_names, want)
    if an != bn:
        return ("columns", len(a), spent, f"{an} != {bn}")
    if len(a) != len(b):
        return ("count", len(a), spent, f"{len(a)} != {len(b)} first {a[:1]} {b[:1]}")
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return ("values", len(a), spent, f"{len(bad)} differ, e.g. {bad[0]}")
    if not a:
        return ("empty", 0, spent, "")
    return ("ok", len(a), spent, "")


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    names = sys.argv[2:] or list(entry.queries())
    fails = 0
    for n in names:
        try:
            res = compare(spark, con, sf, n, entry.queries()[n], entry.oracle_sql().get(n))
        except Exception as e:  # noqa: BLE001
            res = ("error", 0, 0.0, str(e)[:700])
        fails += res[0] not in ("ok", "rows")
        print(f"{res[0]:8s} {n:30s} rows={res[1]:7d} {res[2]:6.1f}s {res[3][:700]}", flush=True)
    print("failures:", fails)
