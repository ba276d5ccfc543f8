"""Inventory, selection and records of table metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered import warehouse
from registered.registry import TABLES, query, run_options, table, table_paths
from registered.warehouse import COLUMNS_SQL
from tableferry.functions.paths import KEY
from tableferry.functions.type_map import logical_type
from tableferry.operators.load import create_external_table
from tableferry.operators.selection import (
    in_listing_order,
    list_columns,
    select_tables,
    table_counts,
    table_records,
)
from tableferry.operators.validation import row_counts
from tableferry.sources.metadata import catalog_metadata, information_schema, parquet_metadata
from tableferry.sources.rules import make_rules, read_rules, split_rules
from tableferry.sources.storage import scratch_directory
from tableferry.sources.tables import catalog_source

_NAMES = ", ".join(f"'{t}'" for t in TABLES)
ROW_COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in TABLES)


@query(
    "inventory_columns",
    f"""SELECT c.table_name, c.column_name, CAST(c.ordinal_position AS INTEGER) AS ordinal, r.n AS source_rows
        FROM information_schema.columns c JOIN ({ROW_COUNTS_SQL}) r ON c.table_name = r.t
        WHERE c.table_name IN ({_NAMES})""",
)
def inventory_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the test tables in listing order, with the table's row count."""
    found = parquet_metadata(spark, table_paths(sf_dir))
    counts = row_counts({t.upper(): table(spark, sf_dir, t) for t in TABLES})
    columns = list_columns(found).join(counts.withColumnRenamed("table_key", "table"), "table")
    return in_listing_order(columns).select(
        F.lower("table").alias("table_name"), "column_name", "ordinal", F.col("rows").alias("source_rows")
    )


@query(
    "inventory_catalog",
    f"""SELECT c.table_name || '_external' AS table_name, c.column_name, CAST(c.ordinal_position AS INTEGER) AS ordinal,
               CASE WHEN c.data_type LIKE '%[]' THEN 'JSON' WHEN c.data_type IN ('BIGINT', 'INTEGER') THEN 'INTEGER'
                    WHEN c.data_type = 'DOUBLE' THEN 'FLOAT64' WHEN c.data_type = 'VARCHAR' THEN 'STRING'
                    ELSE 'TIMESTAMP' END AS type, r.n AS source_rows
        FROM information_schema.columns c JOIN ({ROW_COUNTS_SQL}) r ON c.table_name = r.t
        WHERE c.table_name IN ({_NAMES})""",
)
def inventory_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, logical types and row counts of tables found in the session catalog."""
    options = run_options(spark)
    namespace = f"{options.namespace_prefix}catalog"
    for name in TABLES:
        staged = f"{sf_dir.rstrip('/')}/{name}.parquet"
        create_external_table(spark, staged, options.target_root, namespace, name)
    found = catalog_metadata(spark, [namespace])
    read = catalog_source(spark)
    counts = row_counts({f"{t}_external": read("", namespace, f"{t}_external") for t in TABLES})
    columns = list_columns(found).withColumn("table_name", F.lower("table"))
    return columns.join(counts.withColumnRenamed("table_key", "table_name"), "table_name").select(
        "table_name", "column_name", "ordinal", logical_type("data_type").alias("type"), F.col("rows").alias("source_rows")
    )


RULES = [
    {"database": "db0", "schema": "public", "exclude_table_like": ["tmp_%", "%_TEMP", ""]},
    {"database": "DB1", "exclude_schema_like": ["%tmp%", "raw-%"], "with_views": True},
    {"database": "DB2", "schema": "", "table": ""},
    {"database": "DB0", "with_views": True, "exclude_table_like": ["T\\_%"]},
    {"schema": "PUBLIC"},
    {"database": "DB2", "table": "T_1"},
    {"database": "DB1", "schema": "SALES", "table": "t_21"},
]

SELECTED_SQL = f"""WITH {COLUMNS_SQL}, hits AS (
  SELECT 0 AS rule, * FROM tabs WHERE "database" = 'DB0' AND "schema" = 'PUBLIC' AND table_type = 'BASE TABLE'
    AND "table" NOT LIKE 'TMP_%' AND "table" NOT LIKE '%_TEMP'
  UNION ALL SELECT 1, * FROM tabs WHERE "database" = 'DB1' AND "schema" NOT LIKE '%TMP%' AND "schema" NOT LIKE 'RAW-%'
  UNION ALL SELECT 2, * FROM tabs WHERE "database" = 'DB2' AND table_type = 'BASE TABLE'
  UNION ALL SELECT 3, * FROM tabs WHERE "database" = 'DB0'
  UNION ALL SELECT 6, * FROM tabs WHERE "database" = 'DB1' AND "schema" = 'SALES' AND "table" = 'T_21'
    AND table_type = 'BASE TABLE'
)
SELECT "database", "schema", "table", min(rule) AS rule_pos, max(rule) AS rule_idx, max(table_type) AS table_type
FROM hits GROUP BY "database", "schema", "table" """


@query("inventory_selected", SELECTED_SQL)
def inventory_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables chosen by overlapping rules with excludes, views and invalid rules."""
    return select_tables(make_rules(spark, RULES), warehouse.metadata(spark, sf_dir).tables)


@query(
    "rejected_rules",
    """SELECT 'rule_' || c_custkey AS rule,
              CASE WHEN coalesce(db, '') = '' THEN '''database'' is mandatory'
                   ELSE '''schema'' is mandatory if ''table'' is provided' END AS reject_reason
       FROM (SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN '' ELSE c_mktsegment END AS db,
                    CASE WHEN c_custkey % 2 = 0 THEN c_name END AS sch,
                    CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE c_name END AS tab FROM customer)
       WHERE coalesce(db, '') = '' OR (coalesce(tab, '') <> '' AND coalesce(sch, '') = '')""",
)
def rejected_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation of a JSON rule file with one rule per customer, some incomplete."""
    unset = F.lit(None).cast("array<string>")
    rules = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("rule_idx"),
        F.when(F.col("c_nationkey") % 3 == 0, "").otherwise(F.col("c_mktsegment")).alias("database"),
        F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("schema"),
        F.when(F.col("c_nationkey") % 4 != 0, F.col("c_name")).alias("table"),
        unset.alias("exclude_schema_like"),
        unset.alias("exclude_table_like"),
        F.lit(False).alias("with_views"),
    )
    path = f"{scratch_directory(spark)}/rules"
    rules.write.json(path)
    _, rejected = split_rules(read_rules(spark, path))
    return rejected.select(F.concat(F.lit("rule_"), F.col("rule_idx")).alias("rule"), "reject_reason")


@query(
    "metadata_listing",
    f"""WITH {COLUMNS_SQL} SELECT * FROM cols""",
)
def metadata_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COLUMNS joined with TABLES, both in the form of a warehouse's own views."""
    found = warehouse.metadata(spark, sf_dir)
    renamed = {"database": "table_catalog", "schema": "table_schema", "table": "table_name"}
    columns = found.columns.withColumnsRenamed({**renamed, "ordinal": "ordinal_position"})
    joined = list_columns(information_schema(columns, found.tables.withColumnsRenamed(renamed)))
    return in_listing_order(joined)


@query(
    "table_counts_rollup",
    f"""WITH {COLUMNS_SQL}
        SELECT CASE WHEN grouping(k) = 1 THEN 'Total' ELSE k END AS schema_key, count(*) AS tables
        FROM (SELECT "database" || '.' || "schema" AS k FROM tabs) GROUP BY ROLLUP (k)""",
)
def table_counts_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables per schema and in total."""
    return table_counts(warehouse.metadata(spark, sf_dir).tables)


@query(
    "table_records",
    f"""WITH {COLUMNS_SQL}
        SELECT "database", "schema", "table", CAST(count(*) AS INTEGER) AS column_count,
               string_agg(column_name || ' ' || data_type, ',' ORDER BY ordinal) AS column_list
        FROM cols GROUP BY "database", "schema", "table" """,
)
def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per table with its columns in ordinal order."""
    found = table_records(warehouse.metadata(spark, sf_dir).columns)
    listed = F.transform("columns", lambda c: F.concat_ws(" ", c["column_name"], c["data_type"]))
    return found.select(
        *KEY, F.size("columns").alias("column_count"), F.array_join(listed, ",").alias("column_list")
    )
