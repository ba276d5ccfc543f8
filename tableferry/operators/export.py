"""Unloading a table, a sample of it, or a user's SELECT to Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tableferry.functions.names import dedup_names, normalize_name
from tableferry.functions.type_map import ZONED_TIMESTAMPS, source_type_name
from tableferry.sources.storage import reads_from
from tableferry.sources.tables import run_sql

# Fixed value: rows of a sample unless told otherwise.
DEFAULT_SAMPLE_ROWS = 100

# Spark types without a Parquet form; they are written as text.
_TEXT_ONLY = ("time", "interval", "void")


@dataclass(frozen=True)
class ColumnMapping:
    """One exported column: source name and type, and the target name."""

    column_name: str
    data_type: str
    name: str


@dataclass(frozen=True)
class ExportResult:
    path: str
    rows: int


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def export_projection(
    source: DataFrame, columns: Sequence[ColumnMapping], cast_zoned_timestamps: bool = True
) -> DataFrame:
    """Every column in ordinal order under its target name.

    TIMESTAMP_TZ and TIMESTAMP_LTZ columns become wall-clock timestamps: the wall
    clock of the session time zone for an instant, the written wall clock for
    text with an offset.
    """

    def expression(column: ColumnMapping) -> Column:
        value = F.col(quoted(column.column_name))
        if cast_zoned_timestamps and column.data_type in ZONED_TIMESTAMPS:
            value = value.cast("timestamp_ntz")
        return value.alias(column.name)

    return source.select([expression(c) for c in columns])


def target_names(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Normalized and de-duplicated names of one table's columns."""
    array = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    normalized = F.transform(array, normalize_name)
    return spark.range(1).select(dedup_names(normalized).alias("n")).first().n


def column_mappings(source: DataFrame) -> list[ColumnMapping]:
    """The mapping of a table known only by its frame."""
    names = target_names(source.sparkSession, source.columns)
    return [
        ColumnMapping(field.name, source_type_name(field.dataType), name)
        for field, name in zip(source.schema.fields, names, strict=True)
    ]


def custom_selection(spark: SparkSession, select_sql: str, source: DataFrame) -> DataFrame:
    """A user's SELECT over ``{source}``, with target names from its output columns."""
    selected = run_sql(spark, select_sql, source=source)
    return selected.toDF(*target_names(spark, selected.columns))


def first_rows(source: DataFrame, n: int = DEFAULT_SAMPLE_ROWS) -> DataFrame:
    """The first ``n`` rows in no particular order.

    Over files, a small incremental job finds the files that hold ``n`` rows and
    only those are read: a plain ``limit`` before a write would start a task for
    every split of the table. Only file names pass through the driver.
    """
    try:
        path = source.metadataColumn("_metadata")["file_path"]
        located = source.select(path.alias("file_path"))
    except AnalysisException:  # not a plain file scan
        return source.limit(n)
    files = {row.file_path for row in located.limit(n).distinct().collect()}
    return source.where(path.isin(sorted(files))).limit(n)


def ordered_sample(source: DataFrame, n: int = DEFAULT_SAMPLE_ROWS) -> DataFrame:
    """A reproducible sample: the ``n`` smallest rows by all columns."""
    return source.orderBy(*[F.col(quoted(c)) for c in source.columns]).limit(n)


def storable(frame: DataFrame) -> DataFrame:
    """Cast the types Parquet cannot hold to text."""
    texts = {
        f.name: F.col(quoted(f.name)).cast("string")
        for f in frame.schema.fields
        if f.dataType.simpleString().split("(")[0] in _TEXT_ONLY
    }
    return frame.withColumns(texts) if texts else frame


def export_frame(frame: DataFrame, path: str) -> ExportResult:
    """Write a selection as Snappy Parquet, replacing all earlier files of ``path``.

    The row count is that of the rows written, taken by the write job itself. Spark
    would delete the old files before reading them, so a path that the selection
    reads from is refused.
    """
    if reads_from(frame, path):
        raise ValueError(f"the export would overwrite its own source: {path}")
    observation = Observation()
    (
        storable(frame)
        .observe(observation, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "snappy")
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )
    return ExportResult(path, observation.get["rows"])


def export_selection(
    source: DataFrame,
    columns: Sequence[ColumnMapping],
    sample_rows: int | None = None,
    select_sql: str | None = None,
    cast_zoned_timestamps: bool = True,
) -> DataFrame:
    """What an export writes: a table's projection, or the user's SELECT in place of it."""
    if select_sql:
        frame = custom_selection(source.sparkSession, select_sql, source)
        return frame if sample_rows is None else frame.limit(sample_rows)
    rows = source if sample_rows is None else first_rows(source, sample_rows)
    return export_projection(rows, columns, cast_zoned_timestamps)


def export_table(
    source: DataFrame,
    columns: Sequence[ColumnMapping],
    path: str,
    sample_rows: int | None = None,
    select_sql: str | None = None,
    cast_zoned_timestamps: bool = True,
) -> ExportResult:
    """Export one table: its projection, or the user's SELECT in place of it."""
    return export_frame(export_selection(source, columns, sample_rows, select_sql, cast_zoned_timestamps), path)
