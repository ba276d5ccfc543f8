"""Access to source table data by (database, schema, table)."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tableferry.sources.metadata import TableKey

SourceReader = Callable[[str, str, str], DataFrame]


def parquet_source(spark: SparkSession, paths: Mapping[TableKey, str]) -> SourceReader:
    """Reads each table from its Parquet directory."""

    def read(database: str, schema: str, table: str) -> DataFrame:
        return spark.read.parquet(paths[(database, schema, table)])

    return read


def catalog_source(spark: SparkSession, three_level: bool = False) -> SourceReader:
    """Reads tables by name, ``schema.table`` or ``database.schema.table``."""

    def read(database: str, schema: str, table: str) -> DataFrame:
        parts = (database, schema, table) if three_level else (schema, table)
        return spark.table(".".join(f"`{p.replace('`', '``')}`" for p in parts))

    return read


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """A user's SELECT, evaluated lazily; ``{name}`` refers to a frame passed by name."""
    return spark.sql(query, **frames)
