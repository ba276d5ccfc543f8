"""Names, types, inferred schemas, identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered import warehouse
from registered.registry import query, table
from registered.warehouse import COLUMNS_SQL, FIELDS_SQL, LOGICAL_SQL, dedup_sql, normalize_sql
from tableferry.functions import paths
from tableferry.functions.names import dedup_names, normalize_name
from tableferry.functions.paths import KEY
from tableferry.functions.type_map import logical_type
from tableferry.plans import inference


@query("normalize_urls", f"SELECT page_id, {normalize_sql('url')} AS name FROM pages")
def normalize_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized page URLs: punctuation and digits."""
    return table(spark, sf_dir, "pages").select("page_id", normalize_name("url").alias("name"))


@query("normalize_text_unicode", f"SELECT doc_id, {normalize_sql('text')} AS name FROM documents")
def normalize_text_unicode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalized document texts: accents, line breaks, the cut."""
    return table(spark, sf_dir, "documents").select("doc_id", normalize_name("text").alias("name"))


_HOST = "regexp_extract(url, '://([^/?#]+)', 1)"
_PAGES_PER_TABLE = 50


@query(
    "dedup_names",
    f"""WITH named AS (
          SELECT page_id // {_PAGES_PER_TABLE} AS table_no, list(n ORDER BY page_id) AS names
          FROM (SELECT page_id, {normalize_sql(_HOST)} AS n FROM pages) GROUP BY 1)
        SELECT table_no, CAST(unnest(range(1, len(names) + 1)) AS INTEGER) AS ordinal,
               unnest({dedup_sql("names")}) AS name FROM named""",
)
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host names of 50 consecutive pages at a time as the columns of a table, made unique."""
    host = normalize_name(F.regexp_extract("url", "://([^/?#]+)", 1))
    named = (
        table(spark, sf_dir, "pages")
        .select(F.expr(f"page_id div {_PAGES_PER_TABLE}").alias("table_no"), "page_id", host.alias("n"))
        .groupBy("table_no")
        .agg(F.array_sort(F.collect_list(F.struct("page_id", "n"))).alias("names"))
    )
    unique = dedup_names(F.col("names.n"))
    return named.select("table_no", F.posexplode(unique).alias("pos", "name")).select(
        "table_no", (F.col("pos") + 1).alias("ordinal"), "name"
    )


@query(
    "type_map",
    f"""WITH {COLUMNS_SQL} SELECT data_type, {LOGICAL_SQL} AS logical_type, count(*) AS columns
        FROM cols GROUP BY ALL""",
)
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical type of every source type in use, with the number of columns."""
    columns = warehouse.metadata(spark, sf_dir).columns
    counted = columns.groupBy("data_type").agg(F.count(F.lit(1)).alias("columns"))
    return counted.select("data_type", logical_type("data_type").alias("logical_type"), "columns")


@query(
    "infer_schema",
    f"""WITH {FIELDS_SQL}
        SELECT "database", "schema", "table", ordinal, source_name, name, type, 'NULLABLE' AS mode FROM fields""",
)
def infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target schema of every table."""
    return inference.infer_schema(warehouse.metadata(spark, sf_dir).columns)


@query(
    "schema_json",
    f"""WITH {FIELDS_SQL}
        SELECT "database", "schema", "table", '[' || string_agg('{{"name":"' || name || '","type":"' || type
               || '","mode":"NULLABLE"}}', ',' ORDER BY ordinal) || ']' AS schema_json
        FROM fields GROUP BY "database", "schema", "table" """,
)
def schema_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target schema of every table as JSON."""
    return inference.schema_json(infer_schema(spark, sf_dir))


_DISPLAY_SQL = f"""WITH {FIELDS_SQL}
    SELECT "database", "schema", "table", ordinal, name, type, name || ' (' || type || ')' AS display FROM fields"""


@query("available_columns", _DISPLAY_SQL)
def available_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All target columns with display labels."""
    return inference.available_columns(infer_schema(spark, sf_dir))


@query("partition_eligible", f"{_DISPLAY_SQL} WHERE type IN ('DATE', 'DATETIME', 'TIMESTAMP')")
def partition_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target columns a table can be partitioned by."""
    return inference.partition_eligible(infer_schema(spark, sf_dir))


@query(
    "target_paths",
    f"""WITH {COLUMNS_SQL}
        SELECT "database" || '.' || "schema" || '.' || "table" AS table_key,
               lower("database") || '/' || lower("schema") || '/' || lower("table") || '/' AS stage_path,
               lower(replace('migrated_' || "database" || '_' || "schema", '-', '_')) AS namespace,
               's3://stage/root/' || lower("database" || '/' || "schema" || '/' || "table") || '/*' AS source_uri
        FROM tabs""",
)
def target_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualified name, staging path, namespace and staged-file URI of every table."""
    key = [F.col(k) for k in KEY]
    path = paths.staging_path(*key)
    return warehouse.metadata(spark, sf_dir).tables.select(
        paths.qualified_name(*key).alias("table_key"),
        path.alias("stage_path"),
        paths.namespace_id(*key[:2]).alias("namespace"),
        paths.source_uri("s3://stage/root//", path).alias("source_uri"),
    )
