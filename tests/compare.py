"""Runs a registered query and its SQL twin and compares the rows.

Also a command: ``python -m tests.compare SF_DIR [name ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

from sluice.plans.queries import ORACLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def spark_side(spark, name: str, sf_dir: str):
    df = QUERIES[name](spark, sf_dir)
    return table_of(df.columns, df.collect())


def sql_side(con, name: str):
    result = con.execute(ORACLES[name])
    return table_of([c[0] for c in result.description], result.fetchall())


def main(sf_dir: str, names: list[str]) -> int:
    from tests.conftest import make_session

    spark = make_session()
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            got = spark_side(spark, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            print(f"{name:28} ERROR {str(error)[:1500]}", flush=True)
            failed += 1
            continue
        spent = time.time() - start
        if name not in ORACLES:
            print(f"{name:28} rows={len(got[1]):8} {spent:6.1f}s  no sql", flush=True)
            continue
        start = time.time()
        try:
            want = sql_side(con, name)
        except Exception as error:
            print(f"{name:28} SQL ERROR {str(error)[:1500]}", flush=True)
            failed += 1
            continue
        sql_spent = time.time() - start
        same = got == want
        print(f"{name:28} rows={len(got[1]):8} {spent:6.1f}s  sql {sql_spent:6.1f}s  {'ok' if same else 'DIFF'}", flush=True)
        if not same:
            failed += 1
            print("  columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
            a, b = set(map(repr, got[1])), set(map(repr, want[1]))
            print("  only spark", sorted(a - b)[:3], "\n  only sql  ", sorted(b - a)[:3], len(a - b), len(b - a))
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
