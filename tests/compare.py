"""Run a registered query and its SQL counterpart and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, list):
        return tuple(_value(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    return [names[i] for i in order], sorted(
        (tuple(_value(row[i]) for i in order) for row in rows), key=key)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    return _rows([d[0] for d in cursor.description], cursor.fetchall())
