"""Export and load round trips: write, read back, return the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered.registry import query, run_options, table
from tableferry.operators.export import column_mappings, export_frame, export_table, ordered_sample
from tableferry.operators.load import (
    LoadOptions,
    create_external_table,
    generated_column,
    load_table,
    read_partitioned,
    read_table,
    table_name,
)
from tableferry.operators.validation import row_counts, target_row_count
from tableferry.sources.storage import delete_directory
from tableferry.sources.tables import run_sql

TABLE = "moved"


def exported(source: DataFrame, **settings) -> str:
    """Stage a frame under its target names and return the directory."""
    path = f"{run_options(source.sparkSession).stage_root}/{TABLE}"
    return export_table(source, column_mappings(source), path, **settings).path


def loaded(source: DataFrame, layout: LoadOptions = LoadOptions()) -> tuple[SparkSession, str, str]:
    """Export and load a frame; returns what the table readers take."""
    spark = source.sparkSession
    options = run_options(spark)
    namespace = f"{options.namespace_prefix}wh_public"
    staged = exported(source)
    load_table(spark, staged, options.target_root, namespace, TABLE, layout)
    delete_directory(spark, staged)
    return spark, namespace, TABLE


# --- exports --------------------------------------------------------------------------


@query(
    "export_roundtrip",
    """SELECT o_orderkey AS order_key, o_custkey AS customer_id, o_orderstatus AS _2nd_status,
              o_totalprice AS total_price_usd, o_orderdate AS order_date, o_orderpriority AS _table_priority_
       FROM orders""",
)
def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders under awkward names, exported and read back under normalized ones."""
    awkward = table(spark, sf_dir, "orders").toDF(
        "Order Key", "CUSTOMER.ID", "2nd status", "total-price (USD)", '"order`date"', "_TABLE_priority"
    )
    return spark.read.parquet(exported(awkward))


@query(
    "export_duplicate_names",
    """SELECT o_orderkey AS "key", o_custkey AS key_2, o_totalprice AS key_3, o_orderstatus AS key_2_2
       FROM orders""",
)
def export_duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose normalized names clash, exported under unique ones."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return spark.read.parquet(exported(orders.toDF("key", "key.", "key ", "key 2")))


@query("export_overwrite_clean", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def export_overwrite_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second export to the same directory leaves nothing of the first."""
    orders = table(spark, sf_dir, "orders")
    path = exported(orders)
    return spark.read.parquet(export_frame(orders.where("o_orderstatus = 'F'"), path).path)


@query("export_ts_ntz", "SELECT event_id, ts FROM events")
def export_ts_ntz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instants exported as wall-clock timestamps of the session zone."""
    instants = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return spark.read.parquet(exported(instants))


_OVERRIDE = """SELECT o.o_orderkey AS {q}Order Key{q}, c.c_name AS {q}customer name{q}, o.o_totalprice * 2 AS {q}valid from{q}
               FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
               WHERE o.o_totalprice > 100000 AND c.c_mktsegment = 'BUILDING'"""


@query(
    "export_override_sql",
    """SELECT o.o_orderkey AS order_key, c.c_name AS customer_name, o.o_totalprice * 2 AS valid_from
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
       WHERE o.o_totalprice > 100000 AND c.c_mktsegment = 'BUILDING'""",
)
def export_override_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's SELECT in place of the projection; names come from its output columns."""
    path = f"{run_options(spark).stage_root}/{TABLE}"
    customers = f"parquet.`{sf_dir.rstrip('/')}/customer.parquet`"
    select = _OVERRIDE.replace("{q}", "`").replace("{customer}", customers).replace("{orders}", "{source}")
    export_table(table(spark, sf_dir, "orders"), [], path, select_sql=select)
    return spark.read.parquet(path)


@query(
    "adhoc_sql",
    """SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
       FROM lineitem GROUP BY l_returnflag""",
)
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's query over frames passed by name."""
    select = """SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity
                FROM {lines} GROUP BY l_returnflag"""
    return run_sql(spark, select, lines=table(spark, sf_dir, "lineitem"))


@query("sample_ordered", "SELECT * FROM lineitem ORDER BY ALL LIMIT 100")
def sample_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reproducible sample of 100 rows, exported and read back."""
    return spark.read.parquet(exported(ordered_sample(table(spark, sf_dir, "lineitem"), 100)))


@query(
    "sample_first",
    """SELECT what, least(100, n) AS rows FROM (SELECT count(*) AS n FROM documents)
       CROSS JOIN (VALUES ('sampled'), ('in_source')) AS w (what)""",
)
def sample_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unordered sample: its size, and how many rows of the source it holds."""
    documents = table(spark, sf_dir, "documents")
    sample = spark.read.parquet(exported(documents, sample_rows=100))
    known = documents.join(sample, documents.columns, "left_semi")
    return row_counts({"sampled": sample, "in_source": known}).withColumnRenamed("table_key", "what")


# --- loads ----------------------------------------------------------------------------


@query(
    "load_custom_schema",
    """SELECT c_name, c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, CAST(NULL AS VARCHAR) AS note
       FROM customer""",
)
def load_custom_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers under a user schema: reordered, widened, a required and an absent column."""
    schema = """[{"name": "c_name", "type": "STRING"},
                 {"name": "C_CUSTKEY", "type": "INTEGER", "mode": "REQUIRED"},
                 {"name": "c_nationkey", "type": "INTEGER"},
                 {"name": "c_acctbal", "type": "FLOAT64", "mode": "NULLABLE"},
                 {"name": "note", "type": "STRING"}]"""
    moved = read_table(*loaded(table(spark, sf_dir, "customer"), LoadOptions(custom_schema=schema)))
    return moved.withColumnRenamed("C_CUSTKEY", "c_custkey")


def _rows_per_partition(spark: SparkSession, sf_dir: str, name: str, field: str, unit: str) -> DataFrame:
    layout = LoadOptions(partition_field=field, partition_unit=unit)
    _, namespace, moved = loaded(table(spark, sf_dir, name), layout)
    key = F.col(generated_column(unit))
    return spark.table(table_name(namespace, moved)).groupBy(key.alias("partition_key")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(field).alias("first_value"), F.max(field).alias("last_value")
    )


def _partition_sql(name: str, field: str, pattern: str) -> str:
    return f"""SELECT strftime({field}, '{pattern}') AS partition_key, count(*) AS rows,
                      min({field}) AS first_value, max({field}) AS last_value FROM {name} GROUP BY 1"""


@query("load_partition_hour", _partition_sql("events", "ts", "%Y%m%d%H"))
def load_partition_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows_per_partition(spark, sf_dir, "events", "ts", "HOUR")


@query("load_partition_day", _partition_sql("events", "ts", "%Y%m%d"))
def load_partition_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows_per_partition(spark, sf_dir, "events", "ts", "DAY")


@query("load_partition_month", _partition_sql("lineitem", "l_shipdate", "%Y%m"))
def load_partition_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows_per_partition(spark, sf_dir, "lineitem", "l_shipdate", "MONTH")


@query("load_partition_year", _partition_sql("orders", "o_orderdate", "%Y"))
def load_partition_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows_per_partition(spark, sf_dir, "orders", "o_orderdate", "YEAR")


@query(
    "load_partition_pruned",
    "SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-02-10' AND l_shipdate < TIMESTAMP '1996-04-02'",
)
def load_partition_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date range of a table partitioned by month, read from its three partitions."""
    layout = LoadOptions(partition_field="l_shipdate", partition_unit="MONTH")
    moved = loaded(table(spark, sf_dir, "lineitem"), layout)
    return read_partitioned(*moved, low="1996-02-10", high="1996-04-02")


@query("load_clustered", "SELECT * FROM lineitem WHERE l_suppkey BETWEEN 3 AND 7 AND l_partkey < 1000")
def load_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table clustered by two fields, read back through a filter on them."""
    layout = LoadOptions(cluster_fields=("l_suppkey", "l_partkey"))
    moved = read_table(*loaded(table(spark, sf_dir, "lineitem"), layout))
    return moved.where(F.col("l_suppkey").between(3, 7) & (F.col("l_partkey") < 1000))


@query(
    "load_partition_clustered",
    """SELECT event_type, count(*) AS rows, count(DISTINCT user_id) AS users, min(ts) AS first_ts
       FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY event_type""",
)
def load_partition_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events partitioned by day and clustered by user within the day."""
    layout = LoadOptions(partition_field="ts", partition_unit="DAY", cluster_fields=("user_id", "event_type"))
    recent = read_partitioned(*loaded(table(spark, sf_dir, "events"), layout), low="2024-01-10")
    return recent.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("users"), F.min("ts").alias("first_ts")
    )


@query("load_arrays", "SELECT vec_id, label, len(embedding) AS dims, embedding[1] AS first_value FROM embeddings")
def load_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated values under a user schema, clustered by label."""
    schema = [
        {"name": "vec_id", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "embedding", "type": "FLOAT64", "mode": "REPEATED"},
        {"name": "label", "type": "INTEGER"},
    ]
    layout = LoadOptions(custom_schema=schema, cluster_fields=("label",))
    moved = read_table(*loaded(table(spark, sf_dir, "embeddings"), layout))
    return moved.select(
        "vec_id",
        F.col("label").cast("int").alias("label"),
        F.size("embedding").cast("long").alias("dims"),
        F.col("embedding")[0].cast("float").alias("first_value"),
    )


@query(
    "load_json",
    """SELECT event_type, count(*) AS rows, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
       FROM events GROUP BY event_type""",
)
def load_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text loaded as semi-structured values and queried by path."""
    schema = [{"name": "event_type", "type": "STRING"}, {"name": "props", "type": "JSON"}]
    moved = read_table(*loaded(table(spark, sf_dir, "events"), LoadOptions(custom_schema=schema)))
    k = F.variant_get("props", "$.k", "bigint")
    return moved.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.sum(k).alias("k_sum"))


@query(
    "external_table",
    """SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top_price FROM orders GROUP BY o_orderpriority""",
)
def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate over the staged files through an external table; it replaces an older one."""
    options = run_options(spark)
    namespace = f"{options.namespace_prefix}wh_public"
    for name in ("customer", "orders"):
        staged = exported(table(spark, sf_dir, name))
        target = create_external_table(spark, staged, options.target_root, namespace, TABLE)
    return spark.table(target).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top_price")
    )


@query("load_replaces", "SELECT p_brand, p_partkey, p_size, 0 AS rows_before FROM part")
def load_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load with another schema and layout replaces the first; before both, 0 rows."""
    options = run_options(spark)
    target = (f"{options.namespace_prefix}wh_public", TABLE)
    before = target_row_count(spark, *target)
    parts = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size")
    orders = exported(table(spark, sf_dir, "orders"))
    layout = LoadOptions(partition_field="o_orderdate", partition_unit="YEAR")
    load_table(spark, orders, options.target_root, *target, layout)
    load_table(spark, exported(parts), options.target_root, *target, LoadOptions(cluster_fields=("p_brand",)))
    delete_directory(spark, orders)
    return read_table(spark, *target).withColumn("rows_before", F.lit(before))


@query("load_failure_keeps_old", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def load_failure_keeps_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails in the middle of its rows leaves the table that an earlier load made."""
    options = run_options(spark)
    target = (f"{options.namespace_prefix}wh_public", TABLE)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    load_table(spark, exported(orders), options.target_root, *target)
    holes = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey")))
    required = LoadOptions(custom_schema=[{"name": "o_orderkey", "type": "INTEGER", "mode": "REQUIRED"}])
    try:
        load_table(spark, exported(holes), options.target_root, *target, required)
    except Exception:
        return read_table(spark, *target)
    raise AssertionError("the load did not fail")


@query(
    "load_rows",
    """SELECT layout, count(*) AS source_rows, count(*) AS loaded_rows
       FROM lineitem CROSS JOIN (VALUES ('plain'), ('partitioned'), ('clustered'), ('both')) AS l (layout) GROUP BY layout""",
)
def load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row count that a load reports, for every kind of layout."""
    options = run_options(spark)
    lines = table(spark, sf_dir, "lineitem")
    staged = exported(lines)
    month = {"partition_field": "l_shipdate", "partition_unit": "MONTH"}
    cluster = {"cluster_fields": ("l_suppkey",)}
    layouts = {"plain": {}, "partitioned": month, "clustered": cluster, "both": {**month, **cluster}}
    namespace = f"{options.namespace_prefix}wh_public"
    rows = [
        (name, load_table(spark, staged, options.target_root, namespace, name, LoadOptions(**layout)).rows)
        for name, layout in layouts.items()
    ]
    loads = spark.createDataFrame(rows, "layout string, loaded_rows long")
    return loads.crossJoin(lines.agg(F.count(F.lit(1)).alias("source_rows"))).select("layout", "source_rows", "loaded_rows")
