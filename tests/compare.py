"""Compare a Spark result with the SQL result of DuckDB: same columns, same rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def cell(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float):
        return round(value, 9)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = [tuple(cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(lines, key=repr)


def spark_table(df):
    return table(df.columns, [tuple(r) for r in df.collect()])


def sql_table(connection, sql):
    result = connection.execute(sql)
    return table([d[0] for d in result.description], result.fetchall())


SPARK_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def spark_types(df):
    return {name: SPARK_TYPE.get(kind, kind) for name, kind in df.dtypes}


def sql_types(connection, sql):
    return {name: kind for name, kind, *_ in connection.execute(f"DESCRIBE {sql}").fetchall()}
