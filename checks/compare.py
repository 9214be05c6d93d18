"""Run registered queries in Spark and DuckDB on the same files and compare the rows.

    python -m checks.compare [--dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from feedloom.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "∅"
    if isinstance(value, (float, Decimal)):
        value = round(float(value), 6) + 0.0
        return f"{value:.6f}"
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def compare(spark: SparkSession, con, name: str, build, sql: str | None, folder: str) -> tuple[bool, str]:
    start = time.time()
    df = build(spark, folder)
    got = df.collect()
    spent = time.time() - start
    if sql is None:
        return True, f"{name:28s} rows={len(got):6d} {spent:6.2f}s  (no SQL twin)"
    con_result = con.execute(sql)
    names = [d[0] for d in con_result.description]
    want = con_result.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, f"{name:28s} COLUMNS spark={sorted(df.columns)} duckdb={sorted(names)}"
    a, b = _sorted_rows(df.columns, got), _sorted_rows(names, want)
    if a == b:
        note = "" if a else "  EMPTY"
        return True, f"{name:28s} rows={len(a):6d} {spent:6.2f}s{note}"
    only_a = [r for r in a if r not in set(b)][:2]
    only_b = [r for r in b if r not in set(a)][:2]
    return False, f"{name:28s} DIFFER spark={len(a)} duckdb={len(b)}\n   spark  {str(only_a)[:700]}\n   duckdb {str(only_b)[:700]}"


def main() -> None:
    from checks import registry

    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    spark = build_session("checks", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.sql.session.timeZone": "UTC"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(opts.dir)
    bad = 0
    for name in opts.names or registry.QUERIES:
        try:
            ok, line = compare(spark, con, name, registry.QUERIES[name], registry.ORACLES.get(name), opts.dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            ok, line = False, f"{name:28s} FAILED {type(error).__name__}: {str(error)[:900]}"
        bad += not ok
        print(("ok   " if ok else "BAD  ") + line, flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
