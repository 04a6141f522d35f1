"""Compare a Spark result with DuckDB rows, ignoring order."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

TABLES_DIR = "/root/testdata/sf0.01"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_rows(df) -> Counter:
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[Counter, list[str]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return rows_of(names, result.fetchall()), sorted(names)
