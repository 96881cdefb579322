"""Compare a query with its SQL: columns by name, rows in any order, values exactly.

``python -m workload.check FOLDER [NAME ...]``
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from workload.adapter import TABLES, Supplied
from workload.case import Case


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> tuple[list[str], list[str]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def compare(case: Case, supplied: Supplied, con: duckdb.DuckDBPyConnection) -> str | None:
    """None where both agree, otherwise the first difference."""
    df = case.run(supplied)
    columns, rows = _rows(df.columns, df.collect())
    if case.sql is None:
        return None if rows else "no rows"
    cursor = con.execute(case.sql)
    names = [d[0] for d in cursor.description]
    expected_columns, expected = _rows(names, cursor.fetchall())
    if columns != expected_columns:
        return f"columns {columns} / {expected_columns}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows / {len(expected)}"
    for a, b in zip(rows, expected):
        if a != b:
            return f"\n  {a[:600]}\n  {b[:600]}"
    return None if rows else "no rows"


def main(folder: str, *names: str) -> int:
    from workload.registry import CASES

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    supplied, con = Supplied(spark, folder), connect(folder)
    failed = 0
    for case in CASES:
        if names and case.name not in names:
            continue
        begun = time.time()
        try:
            difference = compare(case, supplied, con)
        except Exception as error:  # report and go on with the other queries
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        failed += difference is not None
        print(f"\n{case.name:32s} {time.time() - begun:6.2f}s {'ok' if difference is None else difference}", flush=True)
    print(f"\nfailed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
