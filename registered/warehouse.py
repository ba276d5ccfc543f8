"""Column metadata of a large warehouse, derived from the ``events`` table.

Each event is one column: eight consecutive events make a table, spread over a few
databases and schemas. The metadata therefore grows with the events.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from registered.registry import table
from tableferry.sources.metadata import Metadata

COLUMNS_PER_TABLE = 8

# Data types given to the columns, in turn.
DATA_TYPES = [
    "NUMBER", "DECIMAL", "NUMERIC", "INT", "INTEGER", "BIGINT", "SMALLINT", "TINYINT", "BYTEINT",
    "FLOAT", "FLOAT4", "FLOAT8", "DOUBLE", "DOUBLE_PRECISION", "REAL", "VARCHAR", "CHAR", "CHARACTER",
    "STRING", "TEXT", "BINARY", "VARBINARY", "BOOLEAN", "DATE", "DATETIME", "TIME", "TIMESTAMP",
    "TIMESTAMP_LTZ", "TIMESTAMP_NTZ", "TIMESTAMP_TZ", "VARIANT", "OBJECT", "ARRAY", "GEOGRAPHY",
    "NUMBER(10,2)", "varchar(255)", "TIMESTAMP_TZ(9)", "DOUBLE PRECISION", " Integer (8) ", "INTERVAL",
]

_SCHEMAS = ["PUBLIC", "SALES", "TMP_STAGE", "RAW-DATA", "RAW_DATA"]


def metadata(spark: SparkSession, sf_dir: str) -> Metadata:
    n = F.expr(f"event_id div {COLUMNS_PER_TABLE}")
    types = F.array(*[F.lit(t) for t in DATA_TYPES])
    schemas = F.array(*[F.lit(s) for s in _SCHEMAS])
    # Neighbouring tables share a name, so that RAW-DATA and RAW_DATA collide.
    label = F.when(n % 7 == 0, "TMP_").when(n % 7 == 1, "TMPX").otherwise("T_")
    ending = F.when(n % 11 == 0, "_TEMP").otherwise("")
    number = F.expr(f"event_id div {COLUMNS_PER_TABLE * 2}").cast("string")
    name = (
        F.when(F.col("user_id") % 4 == 0, F.col("event_type"))
        .when(F.col("user_id") % 4 == 1, F.upper("event_type"))
        .when(F.col("user_id") % 4 == 2, F.concat(F.col("event_type"), F.lit("."), F.col("user_id") % 3 + 2))
        .otherwise(F.concat(F.col("user_id") % 10, F.lit(" "), F.col("event_type"), F.lit("?")))
    )
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("DB"), (F.expr(f"event_id div {COLUMNS_PER_TABLE * 10}") % 3).cast("string")).alias("database"),
        F.element_at(schemas, (n % 5 + 1).cast("int")).alias("schema"),
        F.concat(label, number, ending).alias("table"),
        F.when(n % 13 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"),
        (F.col("event_id") % COLUMNS_PER_TABLE + 1).cast("int").alias("ordinal"),
        name.alias("column_name"),
        F.element_at(types, F.expr(f"int((event_id * 7 + user_id) % {len(DATA_TYPES)} + 1)")).alias("data_type"),
    )
    tables = rows.where(F.col("ordinal") == 1).select("database", "schema", "table", "table_type")
    return Metadata(tables=tables, columns=rows.drop("table_type"))


_TYPE_LIST = "[" + ", ".join(f"'{t}'" for t in DATA_TYPES) + "]"

# The same metadata as SQL, for use as a CTE.
COLUMNS_SQL = f"""
wh AS (
  SELECT event_id, event_id // {COLUMNS_PER_TABLE} AS n, event_id // {COLUMNS_PER_TABLE * 2} AS n2, user_id, event_type
  FROM events
), cols AS (
  SELECT 'DB' || ((event_id // {COLUMNS_PER_TABLE * 10}) % 3) AS "database",
         ['PUBLIC', 'SALES', 'TMP_STAGE', 'RAW-DATA', 'RAW_DATA'][n % 5 + 1] AS "schema",
         CASE n % 7 WHEN 0 THEN 'TMP_' WHEN 1 THEN 'TMPX' ELSE 'T_' END || n2
           || CASE WHEN n % 11 = 0 THEN '_TEMP' ELSE '' END AS "table",
         CASE WHEN n % 13 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type,
         CAST(event_id % {COLUMNS_PER_TABLE} + 1 AS INTEGER) AS ordinal,
         CASE user_id % 4 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
              WHEN 2 THEN event_type || '.' || (user_id % 3 + 2)
              ELSE (user_id % 10) || ' ' || event_type || '?' END AS column_name,
         {_TYPE_LIST}[(event_id * 7 + user_id) % {len(DATA_TYPES)} + 1] AS data_type
  FROM wh
), tabs AS (
  SELECT "database", "schema", "table", table_type FROM cols WHERE ordinal = 1
)"""

_BASE_TYPE = "upper(trim(split_part(data_type, '(', 1)))"
LOGICAL_SQL = f"""CASE
  WHEN {_BASE_TYPE} IN ('NUMBER', 'DECIMAL', 'NUMERIC') THEN 'NUMERIC'
  WHEN {_BASE_TYPE} IN ('INT', 'INTEGER', 'BIGINT', 'SMALLINT', 'TINYINT', 'BYTEINT') THEN 'INTEGER'
  WHEN {_BASE_TYPE} IN ('FLOAT', 'FLOAT4', 'FLOAT8', 'DOUBLE', 'DOUBLE_PRECISION', 'REAL') THEN 'FLOAT64'
  WHEN {_BASE_TYPE} IN ('BINARY', 'VARBINARY') THEN 'BYTES'
  WHEN {_BASE_TYPE} IN ('BOOLEAN', 'DATE', 'DATETIME', 'TIME', 'GEOGRAPHY') THEN {_BASE_TYPE}
  WHEN {_BASE_TYPE} IN ('TIMESTAMP', 'TIMESTAMP_LTZ', 'TIMESTAMP_NTZ', 'TIMESTAMP_TZ') THEN 'TIMESTAMP'
  WHEN {_BASE_TYPE} IN ('VARIANT', 'OBJECT', 'ARRAY') THEN 'JSON'
  ELSE 'STRING' END"""


def normalize_sql(text: str) -> str:
    """SQL for a normalized name; the text has no enclosing double quotes."""
    stripped = f"regexp_replace({text}, '^\\s+|\\s+$', '', 'g')"
    cleaned = f"regexp_replace({stripped}, '[^\\p{{L}}\\p{{N}}_]', '_', 'g')"
    prefixed = f"regexp_replace({cleaned}, '^([^\\p{{L}}_])', '_\\1')"
    collapsed = f"regexp_replace(regexp_replace({prefixed}, '__+', '_', 'g'), '_+$', '')"
    cut = f"left({collapsed}, 300)"
    return (
        f"list_transform([{cut}], lambda x: CASE WHEN x = '' THEN '_' "
        f"WHEN regexp_matches(upper(x), '^_(TABLE|FILE|PARTITION)_') THEN lower(x || '_') ELSE lower(x) END)[1]"
    )


def dedup_sql(names: str) -> str:
    """SQL fold that makes a list of names unique, left to right."""
    return (
        f"list_reduce(list_transform({names}, lambda n: [n]), lambda acc, x: list_append(acc, "
        "CASE WHEN NOT list_contains(acc, x[1]) THEN x[1] ELSE list_filter(list_transform("
        "range(2, len(acc) + 3), lambda k: CASE WHEN x[1] = '_' THEN '_' || k ELSE x[1] || '_' || k END), "
        "lambda c: NOT list_contains(acc, c))[1] END), CAST([] AS VARCHAR[]))"
    )


# Target fields of every column: normalized, de-duplicated, typed.
FIELDS_SQL = f"""{COLUMNS_SQL}, named AS (
  SELECT "database", "schema", "table", list(column_name ORDER BY ordinal) AS source_names,
         list(data_type ORDER BY ordinal) AS data_types,
         list({normalize_sql("column_name")} ORDER BY ordinal) AS names
  FROM cols GROUP BY ALL
), deduped AS (
  SELECT "database", "schema", "table", source_names, data_types, {dedup_sql("names")} AS names FROM named
), fields AS (
  SELECT "database", "schema", "table", ordinal, source_name, data_type, name, {LOGICAL_SQL} AS type
  FROM (SELECT "database", "schema", "table", CAST(unnest(range(1, len(names) + 1)) AS INTEGER) AS ordinal,
               unnest(source_names) AS source_name, unnest(data_types) AS data_type, unnest(names) AS name
        FROM deduped)
)"""
