"""The migration plan: one row per selected table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableferry.functions.paths import (
    DEFAULT_NAMESPACE_PREFIX,
    KEY,
    namespace_id,
    qualified_name,
    staging_location,
    staging_path,
)
from tableferry.functions.type_map import ZONED_TIMESTAMPS
from tableferry.operators.chunks import CHUNK_BYTES
from tableferry.plans.inference import USER_SCHEMA, layout_problem, target_records, with_target_schema

SETTINGS = {
    "override_sql": "string",
    "custom_schema": "string",
    "partition_field": "string",
    "partition_unit": "string",
    "cluster_fields": "array<string>",
    "action": "string",
}

# What a user may declare for a table. ``export`` stages it and leaves the load to a later run.
ACTIONS = ("proceed", "skip", "abort", "export")

_LOCATION = ["stage_path", "stage_location", "namespace", "target_table"]


@dataclass(frozen=True)
class RunOptions:
    """Settings of one migration run. Roots are folders shared by all executors.

    A table with more than ``chunk_bytes`` of source files is exported in chunks, of which a resumed run keeps those that
    are done. ``count_sources``: count the whole source of a sample or a SELECT even if that takes a scan of its own.
    """

    stage_root: str
    target_root: str
    manifest_root: str
    namespace_prefix: str = DEFAULT_NAMESPACE_PREFIX
    sample_rows: int | None = None
    cast_zoned_timestamps: bool = True
    session_tz: str = "UTC"
    max_parallel: int = 1
    chunk_bytes: int = CHUNK_BYTES
    count_sources: bool = True

    def __post_init__(self) -> None:
        for name in ("stage_root", "target_root", "manifest_root"):
            if not getattr(self, name):
                raise ValueError(f"{name} is required")


def build_plan(
    selected: DataFrame,
    columns: DataFrame,
    options: RunOptions,
    settings: DataFrame | None = None,
    outputs: DataFrame | None = None,
) -> DataFrame:
    """Everything a run needs to know per table, computed from metadata only.

    ``settings`` holds per-table choices: KEY and any of ``SETTINGS`` (a SELECT in
    place of the projection, load options, a proceed/skip/abort action); ``outputs``
    are the columns of those SELECTs (``analyze_overrides``). ``target_schema`` is what
    the table will have: the user's schema, else the SELECT's output, else the inferred
    one; ``schema_origin`` says which. A table that cannot be planned, also because its
    schema or layout cannot be, keeps its row and says why in ``error``.
    """
    located = _with_errors(_located(selected, options))
    # Only the columns of selected tables are named, typed and gathered.
    records = target_records(columns.join(selected.select(*KEY), KEY, "left_semi"))
    # Marked apart from the columns, so that who asks for errors alone names and types none.
    plan = located.join(records.withColumn("_known", F.lit(True)), KEY, "left")
    no_columns = F.when(F.col("_known").isNull(), F.lit("no columns known for the table"))
    plan = with_target_schema(_with_settings(plan, settings), outputs)
    # The same words as those of the check before an export.
    of_user = F.when(F.col("schema_origin") == USER_SCHEMA, F.col("schema_error"))
    checked = F.concat(F.lit("Check failed: "), F.coalesce(of_user, layout_problem()))
    return plan.select(
        F.struct("rule_pos", *KEY).alias("seq"),
        *KEY,
        "table_type",
        "table_key",
        "columns",
        _select_sql(options).alias("select_sql"),
        *_LOCATION,
        *SETTINGS,
        "schema_origin",
        "target_schema",
        F.coalesce(no_columns, F.col("error"), checked, F.col("schema_error")).alias("error"),
    )


def _located(selected: DataFrame, options: RunOptions) -> DataFrame:
    database, schema, table = (F.col(k) for k in KEY)
    path = staging_path(database, schema, table)
    return selected.withColumns(
        {
            "table_key": qualified_name(database, schema, table),
            "stage_path": path,
            "stage_location": staging_location(options.stage_root, path),
            "namespace": namespace_id(database, schema, options.namespace_prefix),
            "target_table": F.lower(table),
        }
    )


def _with_settings(plan: DataFrame, settings: DataFrame | None) -> DataFrame:
    given = [c for c in SETTINGS if settings is not None and c in settings.columns]
    if settings is not None:
        # One row per table whatever is given, so that no table is planned twice.
        per_table = settings.groupBy(*KEY).agg(
            *[F.first(c).alias(c) for c in given], F.count(F.lit(1)).alias("_given")
        )
        repeated = F.when(F.col("_given") > 1, F.lit("settings of the table are given more than once"))
        plan = plan.join(per_table, KEY, "left").withColumn("error", F.coalesce("error", repeated))
    plan = plan.withColumns({c: F.lit(None).cast(kind) for c, kind in SETTINGS.items() if c not in given})
    return plan.withColumn("error", F.coalesce("error", _unknown_action()))


def _unknown_action() -> Column:
    known = F.coalesce("action", F.lit(ACTIONS[0])).isin(*ACTIONS)
    return F.when(~known, F.concat(F.lit("unknown action "), F.col("action")))


def rejected_settings(settings: DataFrame, selected: DataFrame) -> DataFrame:
    """Settings that no planned table takes, with ``reject_reason``: a table that was not selected, an unknown action."""
    with_action = settings if "action" in settings.columns else settings.withColumn("action", F.lit(None).cast("string"))
    marked = with_action.join(selected.select(*KEY, F.lit(True).alias("_planned")), KEY, "left")
    reason = F.when(F.col("_planned").isNull(), F.lit("the table is not in the plan")).otherwise(_unknown_action())
    return marked.withColumn("reject_reason", reason).where("reject_reason IS NOT NULL").select(*settings.columns, "reject_reason")


def _quoted(name: Column) -> Column:
    return F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))


def _select_sql(options: RunOptions) -> Column:
    """The SELECT that the export of a table amounts to, for reading and dry runs."""

    def item(c: Column) -> Column:
        value = _quoted(c["column_name"])
        if options.cast_zoned_timestamps:
            cast = F.concat(F.lit("CAST("), value, F.lit(" AS TIMESTAMP_NTZ)"))
            value = F.when(c["data_type"].isin(*ZONED_TIMESTAMPS), cast).otherwise(value)
        return F.concat(value, F.lit(" AS "), _quoted(c["name"]))

    generated = F.concat(
        F.lit("SELECT "),
        F.array_join(F.transform("columns", item), ", "),
        F.lit(" FROM "),
        F.concat_ws(".", *[_quoted(F.col(k)) for k in KEY]),
    )
    statement = F.coalesce("override_sql", generated)
    if options.sample_rows is None:
        return statement
    limited = F.concat(F.lit("SELECT * FROM ("), F.col("override_sql"), F.lit(f") LIMIT {options.sample_rows}"))
    return F.coalesce(limited, F.concat(generated, F.lit(f" LIMIT {options.sample_rows}")))


def _with_errors(located: DataFrame) -> DataFrame:
    """Mark tables that cannot be moved, or whose target another table shares.

    Tables that share a staging path differ in case only and so share their target.
    """
    sharing = F.count(F.lit(1)).over(Window.partitionBy("namespace", "target_table"))
    unusable = F.exists(F.array(*KEY), lambda p: p.isin("", ".", "..") | p.contains("/"))
    error = F.when(unusable, F.lit("a name of the table cannot be used in a path")).when(
        F.col("_sharing") > 1, F.lit("another table has the same target")
    )
    return located.withColumn("_sharing", sharing).select(*located.columns, error.alias("error"))


def with_source_rows(plan: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``source_rows`` from ``table_key, rows`` counts to a plan."""
    rows = counts.select("table_key", F.col("rows").alias("source_rows"))
    return plan.join(rows, "table_key", "left")


def write_plan(plan: DataFrame, path: str) -> None:
    """Save a dry run; nothing of the source is read or written."""
    plan.write.mode("overwrite").json(path)
