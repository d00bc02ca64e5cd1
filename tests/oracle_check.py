"""Compare every query with its SQL on one test folder."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def _plain(value):
    """NaN equals itself, and is not null."""
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def rows_of_spark(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = [tuple(_plain(v) for v in r) for r in df.select(*columns).collect()]
    return columns, sorted(rows, key=_key)


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def compare(got: tuple, expected: tuple) -> str | None:
    """None when equal, else what differs."""
    if got[0] != expected[0]:
        return f"columns {got[0]} != {expected[0]}"
    if len(got[1]) != len(expected[1]):
        return f"{len(got[1])} rows != {len(expected[1])}"
    wrong = [(a, b) for a, b in zip(got[1], expected[1]) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(got[1])} rows differ, first {wrong[0]}"
    return None


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries

    folder = sys.argv[1]
    only = set(sys.argv[2:])
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(folder), oracle_sql()
    for name, query in queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            got = rows_of_spark(query(spark, folder))
            seconds = time.time() - start
            problem = compare(got, rows_of_sql(con, sqls[name])) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem, seconds, got = repr(error)[:1500], time.time() - start, ((), ())
        print(f"{name:32s} {len(got[1]):8d} rows {seconds:6.2f}s {problem or 'ok'}", flush=True)
