"""Row-by-row comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def duck_rows(connection, sql: str) -> tuple[list[str], list[str], Counter]:
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    kinds = [str(c[1]) for c in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    return [names[i] for i in order], [kinds[i] for i in order], rows


def spark_rows(df) -> tuple[list[str], list[str], Counter]:
    names = sorted(df.columns)
    ordered = df.select(names)
    kinds = [f.dataType.simpleString() for f in ordered.schema.fields]
    return names, kinds, Counter(tuple(row) for row in ordered.collect())
