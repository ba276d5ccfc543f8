"""Run registered queries beside their SQL counterparts and compare the results."""

from __future__ import annotations

import datetime
import math

import duckdb
from pyspark.sql import DataFrame

from registered.registry import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(frame: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(frame.columns), _sorted_rows(frame.columns, frame.collect())


def oracle_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), _sorted_rows(names, result.fetchall())
