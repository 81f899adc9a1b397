"""Compares named queries with their SQL on the same Parquet files, in this process."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}") + 0.0
    if isinstance(v, int):
        return float(v) if abs(v) < 2 ** 53 else v
    if isinstance(v, (dt.date, dt.datetime)):
        return str(v)
    return v


def normal(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(([cell(r[i]) for i in order] for r in rows), key=lambda r: [str(type(c)) + str(c) for c in r])


def differences(spark, con, name, run, sql, sf_dir) -> str | None:
    df = run(spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = normal(df.columns, rows), normal(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    if not a:
        return "both empty"
    for x, y in zip(a, b):
        if x != y:
            return f"first difference: {x} != {y}"
    return None


def main(argv):
    from slicemill.plans import all_queries
    from pyspark.sql import SparkSession
    sf_dir = argv[0]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, run in all_queries.QUERIES.items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        t = time.time()
        try:
            why = differences(spark, con, name, run, all_queries.ORACLE.get(name), sf_dir)
        except Exception as e:  # report and go on
            why = f"{type(e).__name__}: {str(e)[:600]}"
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {time.time() - t:6.2f}s {name}{'' if name in all_queries.ORACLE else ' (no sql)'}"
              + (f"\n     {why}" if why else ""), flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
