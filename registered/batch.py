"""Counts, reconciliation, plans and batch runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered import warehouse
from registered.metadata import ROW_COUNTS_SQL
from registered.registry import TABLES, query, run_options, table, table_paths
from registered.warehouse import COLUMNS_SQL, FIELDS_SQL
from tableferry.functions.paths import KEY
from tableferry.operators.selection import select_tables
from tableferry.operators.validation import reconcile, row_counts
from tableferry.plans import planning, running
from tableferry.plans.inference import effective_columns, infer_schema, override_columns
from tableferry.plans.planning import RunOptions, build_plan
from tableferry.sources.metadata import parquet_metadata
from tableferry.sources.rules import make_rules, rules_from_manifest
from tableferry.sources.storage import delete_directory
from tableferry.sources.tables import parquet_source


# --- counts ---------------------------------------------------------------------------


@query("source_row_counts", f"SELECT t AS table_key, n AS rows FROM ({ROW_COUNTS_SQL})")
def source_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: table(spark, sf_dir, t) for t in TABLES})


RECONCILE_SQL = """WITH s AS (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
  t AS (SELECT CASE WHEN l_suppkey % 13 = 0 THEN -l_suppkey ELSE l_suppkey END AS k, count(*) AS n FROM lineitem
        WHERE NOT (l_suppkey % 10 = 1 AND l_quantity > 40) GROUP BY 1)
SELECT 'supplier_' || coalesce(s.k, t.k) AS table_key, coalesce(s.n, 0) AS source_rows, coalesce(s.n, 0) AS expected_rows,
       coalesce(t.n, 0) AS target_rows, coalesce(s.n, 0) - coalesce(t.n, 0) AS difference,
       CASE WHEN coalesce(s.n, 0) = coalesce(t.n, 0) THEN 'succeeded' ELSE 'failed' END AS status,
       CASE WHEN coalesce(s.n, 0) <> coalesce(t.n, 0) THEN
         'Row count mismatch: source=' || coalesce(s.n, 0) || ', target=' || coalesce(t.n, 0) END AS error
FROM s FULL JOIN t ON s.k = t.k"""


@query("reconcile_counts", RECONCILE_SQL)
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of one table per supplier against a target with short and missing tables."""
    lines = table(spark, sf_dir, "lineitem")
    moved = F.when(F.col("l_suppkey") % 13 == 0, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))
    short = (F.col("l_suppkey") % 10 == 1) & (F.col("l_quantity") > 40)

    def counts(frame: DataFrame, key) -> DataFrame:
        counted = frame.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.concat(F.lit("supplier_"), "k").alias("table_key"), "rows")

    return reconcile(counts(lines, F.col("l_suppkey")), counts(lines.where(~short), moved))


# --- plans ----------------------------------------------------------------------------


def _warehouse_plan(spark: SparkSession, sf_dir: str, settings: DataFrame | None = None) -> DataFrame:
    found = warehouse.metadata(spark, sf_dir)
    rules = make_rules(spark, [{"database": f"DB{i}", "with_views": True} for i in range(3)])
    options = RunOptions("s3://stage/", "s3://target", "s3://manifest")
    return build_plan(select_tables(rules, found.tables), found.columns, options, settings)


_PLAN_SQL = f"""{FIELDS_SQL}, planned AS (
  SELECT "database", "schema", "table", 'SELECT ' || string_agg(
           CASE WHEN data_type IN ('TIMESTAMP_TZ', 'TIMESTAMP_LTZ') THEN 'CAST(`' || source_name || '` AS TIMESTAMP_NTZ)'
                ELSE '`' || source_name || '`' END || ' AS `' || name || '`', ', ' ORDER BY ordinal)
         || ' FROM `' || "database" || '`.`' || "schema" || '`.`' || "table" || '`' AS select_sql
  FROM fields GROUP BY "database", "schema", "table"
), located AS (
  SELECT *, 's3://stage/' || lower("database" || '/' || "schema" || '/' || "table") AS stage_location,
         lower(replace('migrated_' || "database" || '_' || "schema", '-', '_')) AS namespace,
         lower("table") AS target_table
  FROM planned
)"""
_SHARED = """CASE WHEN count(*) OVER (PARTITION BY namespace, target_table) > 1
             THEN 'another table has the same target' END"""


@query(
    "dry_run_plan",
    f"""WITH {_PLAN_SQL} SELECT "database" || '.' || "schema" || '.' || "table" AS table_key, select_sql,
        stage_location, namespace, target_table, {_SHARED} AS error FROM located""",
)
def dry_run_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of a whole warehouse, saved and read back; no table data is touched."""
    path = f"{run_options(spark).manifest_root}/dry_run"
    kept = ["table_key", "select_sql", "stage_location", "namespace", "target_table", "error"]
    planning.write_plan(_warehouse_plan(spark, sf_dir).select(*kept), path)
    return spark.read.schema(", ".join(f"{c} string" for c in kept)).json(path)


@query(
    "collision_guard",
    f"""WITH {COLUMNS_SQL}, located AS (
          SELECT *, lower(replace("database" || '_' || "schema", '-', '_')) AS namespace, lower("table") AS target_table
          FROM tabs)
        SELECT "database" || '.' || "schema" || '.' || "table" AS table_key, error
        FROM (SELECT *, {_SHARED} AS error FROM located) WHERE error IS NOT NULL""",
)
def collision_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned tables that would overwrite each other."""
    return _warehouse_plan(spark, sf_dir).where("error IS NOT NULL").select("table_key", "error")


_STEPS_SQL = """steps AS (
  SELECT 'run_' || (o_custkey % 40) AS run_id, o_orderkey AS seq,
         CASE WHEN o_orderkey % 97 = 13 THEN 'abort' WHEN o_orderpriority = '5-LOW' THEN 'skip' ELSE 'proceed' END AS action
  FROM orders), flagged AS (
  SELECT *, coalesce(max(CASE WHEN action = 'abort' THEN 1 ELSE 0 END) OVER (
              PARTITION BY run_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS gone FROM steps)"""


@query(
    "dispositions",
    f"""WITH {_STEPS_SQL}
        SELECT run_id, seq, action,
               CASE WHEN gone = 1 THEN 'Aborted by user' WHEN action = 'skip' THEN 'Skipped by user' END AS reason,
               CASE WHEN gone = 1 OR action = 'skip' THEN 'failed' ELSE 'proceed' END AS decision
        FROM flagged""",
)
def dispositions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions for many runs whose steps carry proceed, skip and abort actions."""
    return running.dispositions(_steps(spark, sf_dir))


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = (
        F.when(F.col("o_orderkey") % 97 == 13, running.ABORT)
        .when(F.col("o_orderpriority") == "5-LOW", running.SKIP)
        .otherwise(running.PROCEED)
    )
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run_"), F.col("o_custkey") % 40).alias("run_id"),
        F.col("o_orderkey").alias("seq"),
        action.alias("action"),
    )


@query(
    "run_totals",
    f"""WITH {_STEPS_SQL}
        SELECT CASE WHEN gone = 1 OR action = 'skip' THEN 'failed' ELSE 'proceed' END AS status, count(*) AS tables
        FROM flagged GROUP BY 1""",
)
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of steps per outcome."""
    decided = running.dispositions(_steps(spark, sf_dir))
    return running.status_totals(decided.withColumnRenamed("decision", "status"))


# --- runs -----------------------------------------------------------------------------


def _plan(spark: SparkSession, sf_dir: str, names, options: RunOptions, settings: DataFrame | None = None) -> DataFrame:
    paths = {key: path for key, path in table_paths(sf_dir).items() if key[2].lower() in names}
    found = parquet_metadata(spark, paths)
    rules = make_rules(spark, [{"database": "WH", "schema": "PUBLIC"}])
    return build_plan(select_tables(rules, found.tables), found.columns, options, settings)


def _settings(spark: SparkSession, rows: list[dict]) -> DataFrame:
    kinds = {"database": "string", "schema": "string", "table": "string", **planning.SETTINGS}
    values = [tuple(row.get(name) for name in kinds) for row in rows]
    return spark.createDataFrame(values, ", ".join(f"{n} {k}" for n, k in kinds.items()))


def _setting(name: str, **values) -> dict:
    return {"database": "WH", "schema": "PUBLIC", "table": name, **values}


def _run(spark: SparkSession, plan: DataFrame, sf_dir: str, options: RunOptions, run_id: str = "run") -> DataFrame:
    """The outcomes of a run; the copies of the tables are not kept."""
    outcomes = running.run(spark, plan, parquet_source(spark, table_paths(sf_dir)), options, run_id)
    _discard_copies(spark, options)
    return outcomes


def _discard_copies(spark: SparkSession, options: RunOptions) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {options.namespace_prefix}wh_public CASCADE")
    delete_directory(spark, options.stage_root)
    delete_directory(spark, options.target_root)


@query(
    "migrate_table",
    """SELECT 'WH.PUBLIC.LINEITEM' AS table_key, count(*) AS source_rows, count(*) AS expected_rows,
              count(*) AS target_rows, 'succeeded' AS status FROM lineitem""",
)
def migrate_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem end to end: exported, loaded by month and clustered, reconciled."""
    options = run_options(spark)
    layout = _setting("LINEITEM", partition_field="l_shipdate", partition_unit="MONTH", cluster_fields=["l_suppkey"])
    plan = _plan(spark, sf_dir, ["lineitem"], options, _settings(spark, [layout]))
    outcomes = _run(spark, plan, sf_dir, options)
    return outcomes.select("table_key", "source_rows", "expected_rows", "target_rows", "status")


_RUN_SQL = f"""SELECT 'WH.PUBLIC.' || upper(t) AS table_key,
  CASE WHEN t IN ('part', 'nation', 'pages', 'region') THEN 'failed' ELSE 'succeeded' END AS status,
  CASE t WHEN 'part' THEN 'Export failed' WHEN 'nation' THEN 'Check failed' WHEN 'region' THEN 'Load failed' WHEN 'pages' THEN 'Skipped by user' END AS error,
  CASE WHEN t IN ('part', 'nation', 'pages') THEN NULL ELSE n END AS source_rows,
  CASE WHEN t IN ('part', 'nation', 'pages', 'region') THEN NULL WHEN t = 'orders' THEN (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')
       ELSE n END AS target_rows
FROM ({ROW_COUNTS_SQL})"""


@query("run_outcomes", _RUN_SQL)
def run_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch over all test tables in which an export, a check and a load fail and one table is skipped."""
    outcomes, options = _run_all(spark, sf_dir)
    _discard_copies(spark, options)
    stage = F.regexp_extract("error", "^(Export failed|Check failed|Load failed|Skipped by user)", 1)
    return outcomes.select("table_key", "status", F.when(stage != "", stage).alias("error"), "source_rows", "target_rows")


def _run_all(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, RunOptions]:
    options = run_options(spark, max_parallel=4)
    settings = _settings(
        spark,
        [
            _setting("PART", override_sql="SELECT no_such_column FROM {source}"),
            _setting("NATION", partition_field="n_name"),
            _setting("REGION", custom_schema='[{"name": "r_name", "type": "JSON"}]'),
            _setting("PAGES", action=running.SKIP),
            _setting("ORDERS", override_sql="SELECT * FROM {source} WHERE o_orderstatus = 'O'"),
        ],
    )
    plan = _plan(spark, sf_dir, TABLES, options, settings)
    return running.run(spark, plan, parquet_source(spark, table_paths(sf_dir)), options, "first"), options


@query(
    "resume_failed",
    f"""SELECT 'WH.PUBLIC.' || upper(t) AS table_key, n AS target_rows, 'succeeded' AS status
        FROM ({ROW_COUNTS_SQL}) WHERE t IN ('part', 'nation', 'pages', 'region')""",
)
def resume_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed tables of a batch, selected from its manifest and run again with mended settings."""
    _, options = _run_all(spark, sf_dir)
    manifest = f"{options.manifest_root}/first"
    rules = rules_from_manifest(running.read_outcomes(spark, manifest, running.FAILED))
    found = parquet_metadata(spark, table_paths(sf_dir))
    plan = build_plan(select_tables(rules, found.tables), found.columns, options)
    source = parquet_source(spark, table_paths(sf_dir))
    outcomes = running.resume(spark, plan, source, options, "second", "first")
    _discard_copies(spark, options)
    return outcomes.select("table_key", "target_rows", "status")


@query(
    "resume_load_only",
    f"""SELECT 'WH.PUBLIC.' || upper(t) AS table_key, n AS source_rows, n AS target_rows, 'succeeded' AS status
        FROM ({ROW_COUNTS_SQL}) WHERE t = 'region'
        UNION ALL
        SELECT 'WH.PUBLIC.' || upper(t), NULL, NULL, 'failed' FROM ({ROW_COUNTS_SQL}) WHERE t IN ('part', 'nation', 'pages')""",
)
def resume_load_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch resumed without its source: a table that was staged is loaded, the others need their export."""

    def gone(database: str, schema: str, name: str) -> DataFrame:
        raise RuntimeError("the source is gone")

    _, options = _run_all(spark, sf_dir)
    outcomes = running.resume(spark, _plan(spark, sf_dir, TABLES, options), gone, options, "second", "first", reload=True)
    _discard_copies(spark, options)
    return outcomes.select("table_key", "source_rows", "target_rows", "status")


@query(
    "remaining_steps",
    f"""WITH {_STEPS_SQL} SELECT run_id, seq, action FROM flagged WHERE gone = 1 OR action = 'skip'""",
)
def remaining_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned steps without an outcome, for many runs at once."""
    steps = _steps(spark, sf_dir)
    done = running.dispositions(steps).where(F.col("decision") == running.PROCEED)
    return running.remaining(steps, done, ["run_id", "seq"]).select("run_id", "seq", "action")


@query(
    "reconcile_sample",
    f"""SELECT 'WH.PUBLIC.' || upper(t) AS table_key, n AS source_rows, least(100, n) AS expected_rows,
               least(100, n) AS target_rows, 'succeeded' AS status
        FROM ({ROW_COUNTS_SQL}) WHERE t IN ('region', 'lineitem', 'documents', 'events')""",
)
def reconcile_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled tables compare with the rows of the sample, not of the whole table."""
    options = run_options(spark, sample_rows=100, max_parallel=4)
    plan = _plan(spark, sf_dir, ["region", "lineitem", "documents", "events"], options)
    outcomes = _run(spark, plan, sf_dir, options)
    return outcomes.select("table_key", "source_rows", "expected_rows", "target_rows", "status")


@query(
    "plan_source_rows",
    f"SELECT 'WH.PUBLIC.' || upper(t) AS table_key, 'migrated_wh_public' AS namespace, t AS target_table, n AS source_rows "
    f"FROM ({ROW_COUNTS_SQL})",
)
def plan_source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run with the row counts of the source."""
    options = RunOptions("s3://stage/", "s3://target", "s3://manifest")
    counts = row_counts({f"WH.PUBLIC.{t.upper()}": table(spark, sf_dir, t) for t in TABLES})
    plan = planning.with_source_rows(_plan(spark, sf_dir, TABLES, options), counts)
    return plan.select("table_key", "namespace", "target_table", "source_rows")


@query(
    "infer_override_schema",
    """SELECT name, type, ordinal, n AS source_rows
       FROM (VALUES ('customer_id', 'INTEGER', 1), ('order_date', 'STRING', 2), ('user_email', 'NUMERIC', 3)) AS f (name, type, ordinal)
       CROSS JOIN (SELECT count(*) AS n FROM customer)""",
)
def infer_override_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target fields of a user's SELECT, planned from its analyzed output; the row count is the source's."""
    override = "SELECT c_custkey AS `customer.id`, c_name AS `order date`, CAST(c_acctbal AS DECIMAL(12, 2)) AS `user@email` FROM {source}"
    settings = _settings(spark, [_setting("CUSTOMER", override_sql=override)])
    source = parquet_source(spark, table_paths(sf_dir))
    columns = parquet_metadata(spark, table_paths(sf_dir)).columns
    fields = infer_schema(effective_columns(columns, override_columns(settings, source))).where("table = 'CUSTOMER'")
    counted = fields.crossJoin(source("WH", "PUBLIC", "CUSTOMER").agg(F.count(F.lit(1)).alias("source_rows")))
    return counted.select("name", "type", "ordinal", "source_rows")


_USER_SCHEMA = '[{"name": "Id", "type": "integer", "mode": "REQUIRED"}, {"name": "seen_at", "type": "timestamp"}, {"name": "price", "type": "numeric(12, 2)"}]'


@query(
    "plan_effective_schema",
    f"""WITH {FIELDS_SQL}, numbered AS (
          SELECT *, CAST(regexp_extract("table", '[0-9]+') AS INTEGER) AS num,
                 lower(replace("database" || '_' || "schema", '-', '_')) AS namespace, lower("table") AS target FROM tabs
        ), shared AS (SELECT *, count(*) OVER (PARTITION BY namespace, target) > 1 AS is_shared FROM numbered),
        effective AS (
          SELECT "database", "schema", "table", ordinal, name, type, 'NULLABLE' AS mode, 'inferred' AS origin
          FROM fields JOIN shared USING ("database", "schema", "table") WHERE num % 4 IN (0, 3)
          UNION ALL
          SELECT "database", "schema", "table", f.ordinal, f.name, f.type, f.mode, 'schema' FROM shared CROSS JOIN
            (VALUES (1, 'Id', 'INTEGER', 'REQUIRED'), (2, 'seen_at', 'TIMESTAMP', 'NULLABLE'), (3, 'price', 'NUMERIC(12,2)', 'NULLABLE'))
            AS f (ordinal, name, type, mode) WHERE num % 4 = 1
          UNION ALL
          SELECT "database", "schema", "table", f.ordinal, f.name, f.type, 'NULLABLE', 'select' FROM shared CROSS JOIN
            (VALUES (1, 'customer_id', 'INTEGER'), (2, 'last_day', 'DATE')) AS f (ordinal, name, type) WHERE num % 4 = 2
        ), wanted AS (
          SELECT *, CASE num % 4 WHEN 1 THEN 'SEEN_AT' WHEN 2 THEN CASE WHEN num % 8 = 2 THEN 'customer_id' ELSE 'last_day' END
                                 WHEN 3 THEN 'view' END AS field FROM shared
        ), temporal AS (
          SELECT w."database", w."schema", w."table", bool_or(lower(name) = lower(field) AND type IN ('DATE', 'DATETIME', 'TIMESTAMP')) AS fits
          FROM wanted w JOIN effective USING ("database", "schema", "table") GROUP BY ALL
        )
        SELECT e."database" || '.' || e."schema" || '.' || e."table" AS table_key, origin, CAST(ordinal AS INTEGER) AS ordinal, name, type, mode,
               CASE WHEN is_shared THEN 'another table has the same target'
                    WHEN field IS NOT NULL AND NOT fits THEN 'Check failed: cannot partition by ' || field || ': needs a temporal column'
               END AS error
        FROM effective e JOIN wanted USING ("database", "schema", "table") JOIN temporal USING ("database", "schema", "table")""",
)
def plan_effective_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schemas of a whole warehouse's plan: given by the user, by a SELECT's output, or inferred."""
    found = warehouse.metadata(spark, sf_dir)
    numbered = found.tables.withColumn("num", F.regexp_extract("table", "[0-9]+", 0).cast("int"))
    kind, text = F.col("num") % 4, F.lit(None).cast("string")
    by_select = F.when(F.col("num") % 8 == 2, "customer_id").otherwise("last_day")
    settings = numbered.where(kind > 0).select(
        *KEY,
        F.when(kind == 1, _USER_SCHEMA).alias("custom_schema"),
        F.when(kind == 2, "SELECT ... FROM {source}").otherwise(text).alias("override_sql"),
        F.when(kind == 1, "SEEN_AT").when(kind == 2, by_select).otherwise("view").alias("partition_field"),
    )
    outputs = (
        "inline(array(named_struct('ordinal', 1, 'column_name', 'customer.id', 'data_type', 'BIGINT'), "
        "named_struct('ordinal', 2, 'column_name', 'last day', 'data_type', 'DATE')))"
    )
    selected = numbered.where(kind == 2).select(*KEY, F.expr(outputs))
    rules = make_rules(spark, [{"database": f"DB{i}", "with_views": True} for i in range(3)])
    options = RunOptions("s3://stage/", "s3://target", "s3://manifest")
    plan = build_plan(select_tables(rules, found.tables), found.columns, options, settings, selected)
    fields = plan.select("table_key", "schema_origin", "error", F.posexplode("target_schema").alias("at", "f"))
    return fields.select(
        "table_key", F.col("schema_origin").alias("origin"), (F.col("at") + 1).alias("ordinal"), "f.name", "f.type", "f.mode", "error"
    )


@query(
    "selected_from_manifest",
    """SELECT n_name AS "schema", c_name AS "table", 'BASE TABLE' AS table_type
       FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal < 0""",
)
def selected_from_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog with a table for each customer, and a manifest that names those in debt one by one."""
    named = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    tables = named.select(
        F.lit("WH").alias("database"),
        F.upper("n_name").alias("schema"),
        F.upper("c_name").alias("table"),
        F.lit("BASE TABLE").alias("table_type"),
        F.struct("n_name", "c_name").alias("spelled"),
        "c_acctbal",
    )
    rules = rules_from_manifest(tables.where("c_acctbal < 0"))
    found = select_tables(rules, tables.drop("spelled", "c_acctbal"))
    return found.join(tables.select("schema", "table", "spelled"), ["schema", "table"]).select(
        F.col("spelled.n_name").alias("schema"), F.col("spelled.c_name").alias("table"), "table_type"
    )
