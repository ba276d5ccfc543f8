"""Target schemas inferred from source column metadata."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tableferry.functions.names import dedup_names, normalize_name
from tableferry.functions.paths import KEY
from tableferry.functions.type_map import DEFAULT_LOGICAL, SPARK_TYPES, TEMPORAL_TYPES, logical_type, source_type_name
from tableferry.operators.load import MAX_CLUSTER_FIELDS, MODES, PARTITION_UNITS, RECORD_TYPES
from tableferry.operators.selection import table_records
from tableferry.sources.metadata import COLUMNS_SCHEMA, error_text
from tableferry.sources.tables import SourceReader, run_sql


def target_records(columns: DataFrame) -> DataFrame:
    """One row per table: KEY and its target fields ``columns`` in ordinal order.

    ``columns`` are metadata rows. An ``alias`` (an output name of a user's SELECT),
    where there is one, wins over the column name; a column without either is
    ``column_<position>``. Names and types are worked out on the flat rows, only the
    de-duplication needs a table's columns together.
    """
    source = F.coalesce("alias", "column_name") if "alias" in columns.columns else F.col("column_name")
    extra = [
        F.when(source.isNotNull(), normalize_name(source)).alias("name"),
        logical_type(F.coalesce("data_type", F.lit(DEFAULT_LOGICAL))).alias("logical_type"),
    ]
    records = table_records(columns, extra)
    numbered = F.transform(
        "columns",
        lambda c, i: F.coalesce(c["name"], F.concat(F.lit("column_"), i.cast("string"))),
    )
    # Zipped, so that the fold over the names runs once per table.
    zipped = F.arrays_zip(F.col("columns").alias("column"), dedup_names(numbered).alias("name"))
    fields = F.transform(zipped, lambda z: z["column"].withField("name", z["name"]))
    return records.select(*KEY, fields.alias("columns"))


def override_columns(settings: DataFrame, source: SourceReader) -> DataFrame:
    """Metadata rows of the output of every ``override_sql``, from its analysis alone; no data is read.

    A SELECT that cannot be analyzed has no rows here; see :func:`analyze_overrides`.
    """
    return analyze_overrides(settings, source).where("error IS NULL").drop("error")


def analyze_overrides(settings: DataFrame, source: SourceReader, parallelism: int = 8) -> DataFrame:
    """The output columns of every ``override_sql`` as metadata rows with ``error``: one row with it where analysis fails."""
    spark = settings.sparkSession

    def analyze(step: Row) -> list[tuple]:
        key = (step.database, step.schema, step.table)
        try:
            schema = run_sql(spark, step.override_sql, source=source(*key)).schema
        except Exception as error:  # the table keeps its row in the plan
            return [(*key, None, None, None, f"the SELECT cannot be analyzed: {error_text(error)}")]
        return [(*key, i, f.name, source_type_name(f.dataType), None) for i, f in enumerate(schema.fields, 1)]

    steps = settings.where("override_sql IS NOT NULL").select(*KEY, "override_sql").toLocalIterator()
    with ThreadPoolExecutor(parallelism) as pool:
        rows = [row for found in pool.map(analyze, steps) for row in found]
    return spark.createDataFrame(rows, f"{COLUMNS_SCHEMA}, error string")


# --- the schema that a load will have -------------------------------------------------

TARGET_SCHEMA = "array<struct<name:string,type:string,mode:string>>"
# Where a target schema comes from.
USER_SCHEMA, SELECT_OUTPUT, INFERRED = "schema", "select", "inferred"


def _null_schema() -> Column:
    return F.lit(None).cast(TARGET_SCHEMA)


def with_target_schema(plan: DataFrame, outputs: DataFrame | None = None) -> DataFrame:
    """Add ``schema_origin``, ``target_schema`` (name, type, mode of each field) and ``schema_error`` to planned tables.

    A user schema wins over the output of a user's SELECT, and that over what is inferred. ``outputs`` are rows of
    :func:`analyze_overrides` or :func:`override_columns`; without them the schema of a SELECT is unknown.
    """
    if outputs is None:
        plan = plan.withColumns({"_selected": _null_schema(), "_failed": F.lit(None).cast("string")})
    else:
        given = outputs if "error" in outputs.columns else outputs.withColumn("error", F.lit(None).cast("string"))
        known = target_records(given.where("error IS NULL").drop("error")).select(*KEY, _fields("columns").alias("_selected"))
        failed = given.groupBy(*KEY).agg(F.max("error").alias("_failed"))
        plan = plan.join(failed, KEY, "left").join(known, KEY, "left")
    parsed = F.from_json("custom_schema", TARGET_SCHEMA)
    plan = plan.withColumn("_parsed", F.when(F.ltrim("custom_schema").startswith("["), parsed))
    user = F.transform(
        "_parsed",
        lambda f: F.struct(
            f["name"].alias("name"),
            F.upper(F.replace(f["type"], F.lit(" "), F.lit(""))).alias("type"),
            F.upper(F.coalesce(F.nullif(f["mode"], F.lit("")), F.lit(MODES[0]))).alias("mode"),
        ),
    )
    by_user, by_select = F.col("custom_schema").isNotNull(), F.col("override_sql").isNotNull()
    origin = F.when(by_user, USER_SCHEMA).when(by_select, SELECT_OUTPUT).otherwise(INFERRED)
    plan = plan.withColumn("_user", user).withColumns({
        "schema_origin": origin,
        "target_schema": F.when(by_user, F.col("_user")).when(by_select, F.col("_selected")).otherwise(_fields("columns")),
    })
    error = F.when(by_user, _schema_problem()).otherwise(F.when(by_select, F.col("_failed")))
    return plan.withColumn("schema_error", error).drop("_selected", "_failed", "_parsed", "_user")


def _fields(columns: str) -> Column:
    """Inferred fields of a table's ``columns``."""
    field = lambda c: F.struct(c["name"].alias("name"), c["logical_type"].alias("type"), F.lit(MODES[0]).alias("mode"))
    return F.transform(columns, field)


def _first(fields: Column, test: Callable[[Column], Column]) -> Column:
    return F.try_element_at(F.filter(fields, test), F.lit(1))


def _base_type(type_name: Column) -> Column:
    return F.substring_index(type_name, "(", 1)


def _schema_problem() -> Column:
    """What is wrong with the fields of a user schema, or null."""
    fields = F.col("_user")
    blank = lambda value: F.coalesce(value, F.lit("")) == ""
    types = [*SPARK_TYPES, *RECORD_TYPES]
    unknown = _first(fields, lambda f: ~_base_type(f["type"]).isin(types))
    mode = _first(fields, lambda f: ~f["mode"].isin(*MODES))
    names = F.transform(fields, lambda f: F.lower(f["name"]))
    return (
        F.when(fields.isNull(), F.lit("the schema is no list of fields"))
        .when(F.exists(fields, lambda f: blank(f["name"]) | blank(f["type"])), F.lit("a field of the schema lacks 'name' or 'type'"))
        .when(unknown.isNotNull(), F.concat(F.lit("unknown type "), unknown["type"], F.lit(" of field "), unknown["name"]))
        .when(mode.isNotNull(), F.concat(F.lit("unknown mode "), mode["mode"], F.lit(" of field "), mode["name"]))
        .when(F.size(F.array_distinct(names)) < F.size(names), F.lit("schema repeats a field name"))
    )


def layout_problem() -> Column:
    """Why ``target_schema`` cannot be laid out as ``partition_field, partition_unit, cluster_fields`` ask, or null.

    Null also where the schema is not known.
    """
    fields, wanted = F.col("target_schema"), F.lower("partition_field")
    field = _first(fields, lambda f: F.lower(f["name"]) == wanted)
    temporal = _base_type(field["type"]).isin(*TEMPORAL_TYPES) & (field["mode"] != MODES[2])
    unit = F.coalesce("partition_unit", F.lit("DAY"))
    partitioned = F.col("partition_field").isNotNull()
    names = F.transform(fields, lambda f: F.lower(f["name"]))
    clusters = F.transform("cluster_fields", lambda c: F.lower(c))
    missing = F.filter("cluster_fields", lambda c: ~F.array_contains(names, F.lower(c)))
    return F.when(
        fields.isNotNull(),
        F.when(~unit.isin(*PARTITION_UNITS), F.lit(f"partition unit must be one of {PARTITION_UNITS}"))
        .when(
            partitioned & ~F.coalesce(temporal, F.lit(False)),
            F.concat(F.lit("cannot partition by "), F.col("partition_field"), F.lit(": needs a temporal column")),
        )
        .when(
            partitioned & (unit == "HOUR") & (_base_type(field["type"]) == "DATE"),
            F.concat(F.lit("cannot partition the date "), F.col("partition_field"), F.lit(" by HOUR")),
        )
        .when(
            (F.size("cluster_fields") > MAX_CLUSTER_FIELDS) | (F.size(F.array_distinct(clusters)) < F.size("cluster_fields")),
            F.lit(f"cluster fields must be at most {MAX_CLUSTER_FIELDS} and distinct"),
        )
        .when(F.size(missing) > 0, F.concat(F.lit("cluster fields not in the table: ['"), F.array_join(missing, "', '"), F.lit("']"))),
    )


def planned_fields(plan: DataFrame) -> DataFrame:
    """``KEY, ordinal, name, type, mode`` of every field that a plan's tables will have, for labels and eligible columns."""
    return plan.select(*KEY, F.posexplode("target_schema").alias("at", "f")).select(
        *KEY, (F.col("at") + 1).alias("ordinal"), F.col("f.name").alias("name"), F.col("f.type").alias("type"), F.col("f.mode").alias("mode")
    )


def effective_columns(columns: DataFrame, overrides: DataFrame) -> DataFrame:
    """Metadata rows with those of ``overrides`` in place of a table's own."""
    replaced = overrides.select(*KEY).distinct()
    return columns.join(replaced, KEY, "left_anti").unionByName(overrides)


def infer_schema(columns: DataFrame) -> DataFrame:
    """``KEY, ordinal, source_name, name, type, mode`` of every target column."""
    return target_records(columns).select(*KEY, F.explode("columns").alias("f")).select(
        *KEY,
        F.col("f.ordinal").alias("ordinal"),
        F.col("f.column_name").alias("source_name"),
        F.col("f.name").alias("name"),
        F.col("f.logical_type").alias("type"),
        F.lit("NULLABLE").alias("mode"),
    )


def schema_json(inferred: DataFrame) -> DataFrame:
    """One row per table: its schema as JSON ``[{name, type, mode}]`` in column order."""
    field = F.struct("ordinal", "name", "type", "mode")
    ordered = F.array_sort(F.collect_list(field))
    return inferred.groupBy(*KEY).agg(
        F.to_json(
            F.transform(ordered, lambda f: F.struct(*[f[n].alias(n) for n in ("name", "type", "mode")]))
        ).alias("schema_json")
    )


def available_columns(inferred: DataFrame) -> DataFrame:
    """All target columns with a display label ``name (TYPE)``."""
    label = F.concat(F.col("name"), F.lit(" ("), F.col("type"), F.lit(")"))
    return inferred.select(*KEY, "ordinal", "name", "type", label.alias("display"))


def partition_eligible(inferred: DataFrame) -> DataFrame:
    """The columns a table can be partitioned by."""
    single = inferred.where(F.col("mode") != MODES[2]) if "mode" in inferred.columns else inferred
    return available_columns(single).where(_base_type(F.col("type")).isin(*TEMPORAL_TYPES))
