"""Registry of queries with their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tableferry.plans.planning import RunOptions
from tableferry.sources.storage import scratch_directory

Query = Callable[[SparkSession, str], DataFrame]

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_paths(sf_dir: str) -> dict[tuple[str, str, str], str]:
    """The test tables as the tables of database WH, schema PUBLIC."""
    return {("WH", "PUBLIC", t.upper()): f"{sf_dir.rstrip('/')}/{t}.parquet" for t in TABLES}


def run_options(spark: SparkSession, **settings) -> RunOptions:
    """Options for one call: a fresh scratch folder and namespaces of its own."""
    root = scratch_directory(spark)
    return RunOptions(
        stage_root=f"{root}/stage",
        target_root=f"{root}/target",
        manifest_root=f"{root}/manifest",
        namespace_prefix=f"run_{uuid.uuid4().hex[:12]}_",
        session_tz=spark.conf.get("spark.sql.session.timeZone"),
        **settings,
    )
