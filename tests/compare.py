"""Run registered queries against their SQL: ``python -m tests.compare [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return Counter(tuple(_plain(row[index]) for index in order) for row in rows)


def differences(spark, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; None when nothing does."""
    df = contract.queries()[name](spark, sf_dir)
    ours = [tuple(row) for row in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return None if ours else "no rows"
    relation = connection.sql(sql)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}"
    left, right = _rows(df.columns, ours), _rows(relation.columns, relation.fetchall())
    if not left:
        return "no rows"
    if left == right:
        return None
    only_left, only_right = list((left - right).items()), list((right - left).items())
    return (
        f"{sum(left.values())} rows != {sum(right.values())} rows; {len(only_left)} only in "
        f"Spark, {len(only_right)} only in SQL\n  columns {sorted(df.columns)}\n"
        f"  Spark {only_left[:2]}\n  SQL   {only_right[:2]}"
    )


def main(sf: str, names: list[str]) -> None:
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{sf}"
    connection = connect(sf_dir)
    failed = 0
    for name in names or sorted(contract.queries()):
        started = time.time()
        try:
            problem = differences(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{name:36s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "0.01", sys.argv[2:])
