"""Run named queries in Spark and their SQL oracles in DuckDB on the same parquet tables and compare.

Comparison: columns sorted by name, rows compared as multisets, floats rounded to 6 digits.
Usage: python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0) for x in row)


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=_key)
    return cols, out


def compare(spark, sf_dir: str, name: str, con=None) -> tuple[bool, str]:
    import __spark_entry__ as e

    con = con or duck(sf_dir)
    t0 = time.time()
    df = e.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    sql = e.oracle_sql()[name]
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    scols, s = normalise(df.columns, srows)
    dcols, d = normalise(dcols, drows)
    if scols != dcols:
        return False, f"columns differ: spark={scols} duckdb={dcols}"
    if len(s) != len(d):
        return False, f"row counts differ: spark={len(s)} duckdb={len(d)}"
    if s != d:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        return False, f"values differ ({len(s)} rows), first: {diff}"
    return True, f"{len(s)} rows, spark {t1 - t0:.2f}s"


def main(argv):
    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as e

    names = argv[2:] or sorted(e.oracle_sql())
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            ok, msg = compare(spark, sf_dir, n, con)
        except Exception as exc:  # report and go on
            ok, msg = False, f"ERROR {type(exc).__name__}: {str(exc)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n}: {msg}", flush=True)
    missing = sorted(set(e.queries()) - set(e.oracle_sql()))
    print(f"{len(names) - bad}/{len(names)} match; rows-only (no oracle): {missing}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
