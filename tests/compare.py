"""Comparing a Spark result with the same query in another engine, row by row and without order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    shaped = [tuple(_value(row[at]) for at in order) for row in rows]
    return sorted(shaped, key=repr)


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(connection, sql: str):
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    return sorted(columns), canonical(columns, result.fetchall())
