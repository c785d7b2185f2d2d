"""Row sets of Spark and DuckDB in one comparable form."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(row) for row in frame.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def kinds(frame):
    """Column types in the words DuckDB uses."""
    words = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "binary": "BLOB"}
    return {name: words.get(kind, kind) for name, kind in frame.dtypes}


def duck_kinds(connection, sql):
    return {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
