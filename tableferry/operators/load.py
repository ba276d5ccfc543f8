"""Loading staged Parquet into target tables."""

from __future__ import annotations

import json
import math
import re
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, replace
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.type_map import SPARK_TYPES, TEMPORAL_TYPES, logical_name
from tableferry.operators.export import quoted
from tableferry.operators.replacement import Swap, existing, literal, recorded, recover, rename, table_location, table_name
from tableferry.sources.storage import delete_directory, directory_bytes, qualified, scratch_directory

# Partition units, field modes and the largest number of cluster fields.
PARTITION_UNITS = ("HOUR", "DAY", "MONTH", "YEAR")
MODES = ("NULLABLE", "REQUIRED", "REPEATED")
RECORD_TYPES = ("RECORD", "STRUCT")
MAX_CLUSTER_FIELDS = 4

GENERATED_PREFIX = "__p_"
MIB = 1024 * 1024
BYTES_PER_TASK = 256 * MIB
#: Bytes of rows, as a sort holds them, that a task should get; Parquet holds repeated values in far fewer bytes.
ROW_BYTES_PER_TASK = 512 * MIB
#: What a text, binary or nested field is taken to need in a row beside the 8 bytes of every field.
LONG_FIELD = 24
POSITION = GENERATED_PREFIX + "position"
#: Bytes of text and binary fields of a row that Spark samples to choose the ranges of a clustered load.
RANGE_BYTES = 24
#: Partitions whose places are broadcast (some 40 MB); of more they are joined by shuffle.
MOST_PLACED = 1_000_000

_PARTITION_FIELD = "tableferry.partition_field"
_PARTITION_UNIT = "tableferry.partition_unit"
_CLUSTER_FIELDS = "tableferry.cluster_fields"
_PREVIOUS = "tableferry.previous"


@dataclass(frozen=True)
class LoadOptions:
    """How to lay out a target table. ``custom_schema`` is JSON text or its parsed list."""

    custom_schema: str | Sequence[dict[str, Any]] | None = None
    partition_field: str | None = None
    partition_unit: str = "DAY"
    cluster_fields: Sequence[str] = ()


@dataclass(frozen=True)
class LoadResult:
    target: str
    rows: int


# --- user schemas ---------------------------------------------------------------------


def parse_schema(custom_schema: str | Sequence[dict[str, Any]]) -> list[tuple[str, str, str]]:
    """(name, type, mode) of each field; the mode defaults to NULLABLE."""
    fields = json.loads(custom_schema) if isinstance(custom_schema, str) else list(custom_schema)
    if not isinstance(fields, list):
        raise ValueError("schema must be a list of fields")
    parsed = []
    for field in fields:
        if not isinstance(field, dict) or not field.get("name") or not field.get("type"):
            raise ValueError(f"schema field needs 'name' and 'type': {field}")
        type_name, mode = field["type"].upper().replace(" ", ""), (field.get("mode") or "NULLABLE").upper()
        field_type(field)
        if mode not in MODES:
            raise ValueError(f"unknown mode {field['mode']} of field {field['name']}")
        parsed.append((field["name"], type_name, mode))
    if len({name.lower() for name, _, _ in parsed}) != len(parsed):
        raise ValueError("schema repeats a field name")
    return parsed


def field_type(field: dict[str, Any]) -> T.DataType:
    """The Spark type of a schema field without its mode.

    NUMERIC and its kin may give precision and scale, text and bytes a length (which
    nothing enforces); a RECORD has ``fields`` of its own.
    """
    match = re.fullmatch(r"(\w+)(?:\((\d+)(?:,(\d+))?\))?", field["type"].upper().replace(" ", ""))
    name, first, second = match.groups() if match else (None, None, None)
    if name in RECORD_TYPES:
        inner = field.get("fields") or []
        types = [field_type(f) for f, _ in zip(inner, parse_schema(inner), strict=True)]
        repeated = [(f.get("mode") or "").upper() == "REPEATED" for f in inner]
        return T.StructType([T.StructField(f["name"], T.ArrayType(t) if r else t) for f, t, r in zip(inner, types, repeated)])
    kind = SPARK_TYPES.get(name)
    if kind is None or first is not None and not isinstance(kind, (T.DecimalType, T.StringType, T.BinaryType)):
        raise ValueError(f"unknown type {field['type']} of field {field['name']}")
    if first is not None and isinstance(kind, T.DecimalType):
        if not 0 <= int(second or 0) <= int(first) <= 38:
            raise ValueError(f"a decimal holds at most 38 digits: {field['type']} of field {field['name']}")
        return T.DecimalType(int(first), int(second or 0))
    return kind


def enforce_schema(
    frame: DataFrame,
    custom_schema: str | Sequence[dict[str, Any]],
    carry: Sequence[str] = (),
) -> DataFrame:
    """Reorder, cast and check a frame by name against a user schema.

    Values that do not fit raise; a REQUIRED field raises on the first null. JSON
    fields are parsed from text; nested input stays as it is. Columns in ``carry``
    are kept behind the fields of the schema.
    """
    fields = parse_schema(custom_schema)
    given = json.loads(custom_schema) if isinstance(custom_schema, str) else custom_schema
    types = {f["name"]: field_type(f) for f in given}
    present = {f.name.lower(): f for f in frame.schema.fields}
    parsed_json, target = {}, []
    for name, type_name, mode in fields:
        found = present.get(name.lower())
        data_type = types[name]
        if mode == "REQUIRED" and found is None:
            raise ValueError(f"required field {name} is not in the data")
        if mode == "REPEATED":
            data_type = T.ArrayType(data_type)
        elif type_name == "JSON" and found is not None:
            if isinstance(found.dataType, T.StringType):
                parsed_json[found.name] = F.parse_json(F.col(quoted(found.name)))
            else:
                data_type = found.dataType
        target.append(T.StructField(name, data_type, True))
    target += [frame.schema[name] for name in carry]
    shaped = (frame.withColumns(parsed_json) if parsed_json else frame).to(T.StructType(target))

    def checked(name: str, mode: str) -> Column:
        value = F.col(quoted(name))
        if mode != "REQUIRED":
            return value
        problem = F.raise_error(F.lit(f"null in required field {name}"))
        return F.when(value.isNull(), problem).otherwise(value).alias(name)

    return shaped.select([checked(name, mode) for name, _, mode in fields] + list(carry))


# --- layout ---------------------------------------------------------------------------


def check_options(schema: T.StructType, options: LoadOptions) -> LoadOptions:
    """Reject layout options that do not fit the effective schema.

    Returns them with the field names spelled as in the schema.
    """
    by_name = {f.name.lower(): f for f in schema.fields}
    generated = [f.name for f in schema.fields if f.name.lower().startswith(GENERATED_PREFIX)]
    if generated:
        raise ValueError(f"column names starting with {GENERATED_PREFIX} are reserved: {generated}")
    if options.partition_unit not in PARTITION_UNITS:
        raise ValueError(f"partition unit must be one of {PARTITION_UNITS}")
    if options.partition_field is not None:
        field = by_name.get(options.partition_field.lower())
        if field is None or logical_name(field.dataType) not in TEMPORAL_TYPES:
            raise ValueError(f"cannot partition by {options.partition_field}: needs a temporal column")
        if options.partition_unit == "HOUR" and isinstance(field.dataType, T.DateType):
            raise ValueError(f"cannot partition the date {options.partition_field} by HOUR")
    clusters = [c.lower() for c in options.cluster_fields]
    if len(clusters) > MAX_CLUSTER_FIELDS or len(set(clusters)) != len(clusters):
        raise ValueError(f"cluster fields must be at most {MAX_CLUSTER_FIELDS} and distinct")
    missing = [c for c in options.cluster_fields if c.lower() not in by_name]
    if missing:
        raise ValueError(f"cluster fields not in the table: {missing}")
    spelled = options.partition_field and by_name[options.partition_field.lower()].name
    return replace(options, partition_field=spelled, cluster_fields=tuple(by_name[c].name for c in clusters))


def generated_column(unit: str) -> str:
    return GENERATED_PREFIX + unit.lower()


def partition_key(value: Column, data_type: T.DataType, unit: str) -> Column:
    """``yyyy[MM[dd[HH]]]`` of a temporal value; sorts like the value itself.

    The key never depends on the session time zone: an instant is keyed by its UTC
    date and hour, a wall-clock timestamp by its own date fields (``date_format``
    would move it across a daylight-saving gap). Years that do not fit four digits
    would break the order and raise.
    """
    if isinstance(data_type, T.TimestampType):
        epoch = F.lit("1970-01-01").cast("timestamp_ntz")
        value = F.timestamp_add("MICROSECOND", F.unix_micros(value), epoch)
    year = F.year(value)
    checked = F.when(~year.between(0, 9999), F.raise_error(F.lit("cannot partition by years beyond 9999")))
    parts = [F.lpad(checked.otherwise(year).cast("string"), 4, "0")]
    for read, since in ((F.month, "MONTH"), (F.day, "DAY"), (F.hour, "HOUR")):
        if PARTITION_UNITS.index(unit) <= PARTITION_UNITS.index(since):
            parts.append(F.lpad(read(value).cast("string"), 2, "0"))
    return F.concat(*parts)


def lay_out(frame: DataFrame, options: LoadOptions, staged_bytes: int, rows: int = 0) -> DataFrame:
    """Distribute rows for the write.

    Without options the scan is written as it is, without a shuffle. Partitioning
    alone deals rows by partition; one that holds more rows than a task should is
    cut into slices first, found by one count of the partition column, so that a hot
    partition is split whatever its rows look like and whether or not AQE is on, and
    slices are placed so that all tasks get about as many rows.
    Clustering deals ranges of (partition, cluster fields) and sorts each. In both cases
    the row's position in the staged files (column ``POSITION``) tells equal rows apart, so
    that whole copies spread over many tasks, and the split is the same when a task runs again.
    What is shuffled beside the rows is one number. There are tasks enough that none has to sort more than
    ``ROW_BYTES_PER_TASK`` of the ``rows``.
    """
    part = []
    if options.partition_field is not None:
        name = generated_column(options.partition_unit)
        field = options.partition_field
        key = partition_key(F.col(quoted(field)), frame.schema[field].dataType, options.partition_unit)
        frame = frame.withColumn(name, key)
        part = [name]
    tasks = max(shuffle_tasks(frame.sparkSession, staged_bytes), math.ceil(rows * row_bytes(frame.schema) / ROW_BYTES_PER_TASK))
    if part or options.cluster_fields:
        # One number of a row that is near its neighbours', so that it takes little room in a shuffle.
        place = F.xxhash64(F.col(POSITION)["file_name"]).bitwiseXOR(F.col(POSITION)["row_index"])
        frame = frame.withColumn(POSITION, place)
    if not options.cluster_fields:
        return _deal_partitions(frame, part[0], tasks) if part else frame
    keys = [F.col(quoted(c)) for c in [*part, *options.cluster_fields]]
    bounds = range_keys(frame.schema, [*part, *options.cluster_fields])
    return frame.repartitionByRange(tasks, *bounds, F.xxhash64(POSITION)).sortWithinPartitions(*keys).drop(POSITION)


def range_keys(schema: T.StructType, fields: Sequence[str]) -> list[Column]:
    """What stands for a row's fields when ranges are chosen: of fixed width, and in the order of the fields.

    Spark brings a sample of these to the driver, so a text or binary field is cut: the fields share ``RANGE_BYTES``.
    Rows that differ beyond it may lie in neighbouring tasks in either order. A nested field is told by its hash,
    which keeps equal values together.
    """
    kinds = {c: schema[c].dataType for c in fields}
    long_ones = [c for c, kind in kinds.items() if isinstance(kind, (T.StringType, T.BinaryType))]
    width = RANGE_BYTES // max(1, len(long_ones))

    def key(name: str) -> Column:
        value, kind = F.col(quoted(name)), kinds[name]
        if name in long_ones:
            return F.substring(value.cast("binary"), 1, width)
        return F.xxhash64(value) if isinstance(kind, (T.ArrayType, T.StructType, T.MapType, T.VariantType)) else value

    return [key(c) for c in fields]


def _deal_partitions(frame: DataFrame, part: str, tasks: int) -> DataFrame:
    """Rows dealt to tasks in the order of partitions, each task with about as many; found by one count of the partitions.

    A partition begins where the one before it ends. One of more than half a task's rows is cut into slices of at most
    that many, by the row's position, so no task holds more than one and a half of its share.
    """
    counts = frame.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each partition of the table; the windows run over these alone.
    before = F.sum("_rows").over(Window.orderBy(part)) - F.col("_rows")
    share = F.ceil(F.sum("_rows").over(Window.partitionBy()) / tasks)
    slices = F.ceil(F.col("_rows") * 2 / F.col("_share")).cast("int")
    path = scratch_directory(frame.sparkSession)
    placed = counts.select(F.col(part).alias("_part"), "_rows", before.alias("_before"), share.alias("_share"))
    placed.withColumn("_slices", slices).write.parquet(path)
    placed = frame.sparkSession.read.parquet(path)
    if placed.count() <= MOST_PLACED:
        placed = F.broadcast(placed)
    found = frame.join(placed, F.col(part).eqNullSafe(F.col("_part")), "left")
    own = F.pmod(F.xxhash64(POSITION), F.col("_slices"))
    start = F.col("_before") + own * F.col("_rows") / F.col("_slices")
    task = F.least(F.floor(start / F.col("_share")), F.lit(tasks - 1)).cast("int")
    # Placed before the shuffle, which carries all columns that its expressions read.
    dealt = found.withColumn("_task", task).drop("_part", "_rows", "_before", "_share", "_slices", POSITION)
    return dealt.repartitionById(tasks, "_task").drop("_task")


def shuffle_tasks(spark: SparkSession, staged_bytes: int) -> int:
    """One task per 256 MiB of staged files, and at least one for each core."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(staged_bytes / BYTES_PER_TASK))


def row_bytes(schema: T.StructType) -> int:
    """About how many bytes a row of the schema takes while it is shuffled and sorted."""
    long_ones = (T.StringType, T.BinaryType, T.ArrayType, T.StructType, T.MapType, T.VariantType)
    return 8 + sum(8 + LONG_FIELD * isinstance(f.dataType, long_ones) for f in schema.fields if f.name != POSITION)


# --- target tables --------------------------------------------------------------------


def with_position(staged: DataFrame) -> DataFrame:
    """Add ``POSITION``: the file and place of each row, also where a column is named ``_metadata``."""
    place = staged.metadataColumn("_metadata")
    return staged.select("*", F.struct(place["file_name"], place["row_index"]).alias(POSITION))


def check_load(spark: SparkSession, schema: T.StructType, options: LoadOptions) -> list[str]:
    """Raise what a load of rows of this schema would raise before it reads any.

    Returns the columns that a user schema leaves out.
    """
    empty = spark.createDataFrame([], schema)
    frame = empty if options.custom_schema is None else enforce_schema(empty, options.custom_schema)
    check_options(frame.schema, options)
    given = {f.name.lower() for f in frame.schema.fields}
    return [f.name for f in schema.fields if f.name.lower() not in given]


def create_namespace(spark: SparkSession, namespace: str, root: str) -> None:
    location = literal(f"{root.rstrip('/')}/{namespace}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(namespace)} LOCATION {location}")


def load_table(
    spark: SparkSession,
    staged_path: str,
    target_root: str,
    namespace: str,
    table: str,
    options: LoadOptions = LoadOptions(),
) -> LoadResult:
    """Replace ``namespace.table`` with the rows staged under ``staged_path``.

    The rows go to a fresh directory first and the catalog entry is swapped after
    that, so a failed load leaves the old table as it was, and one that lost its driver
    leaves it to :func:`recover`, which begins each load.
    """
    create_namespace(spark, namespace, target_root)
    recover(spark, namespace, table)
    staged = spark.read.parquet(staged_path)
    carry, rows = [], 0
    if options.cluster_fields or options.partition_field:
        rows = staged.count()  # of the footers
        staged, carry = with_position(staged), [POSITION]
    frame = staged
    if options.custom_schema is not None:
        frame = enforce_schema(staged, options.custom_schema, carry)
    options = check_options(frame.drop(POSITION).schema, options)

    laid_out = lay_out(frame, options, directory_bytes(spark, staged_path), rows)
    part = [generated_column(options.partition_unit)] if options.partition_field else []
    versions = f"{target_root.rstrip('/')}/{namespace}/{table}"
    location = f"{versions}/v-{uuid.uuid4().hex}"
    previous = table_location(spark, namespace, table)
    before_that = _property(spark, namespace, table, _PREVIOUS) if previous else None
    # Readers of the version to be replaced may go on; of those before it only directories of earlier loads go.
    gone = before_that and qualified(spark, before_that).startswith(f"{qualified(spark, versions)}/v-")
    swap = Swap(namespace, table, location, before_that if gone else None)
    observation = Observation()
    # Counted in the stage that writes, where a rerun task is counted once.
    counted = laid_out.observe(observation, F.count(F.lit(1)).alias("rows"))
    with recorded(spark, swap):
        try:
            writer = counted.write.partitionBy(*part) if part else counted.write
            writer.parquet(location)
            _swap(spark, laid_out.schema, swap, options, part, previous)
        except Exception:
            delete_directory(spark, location)
            raise
    return LoadResult(f"{namespace}.{table}", observation.get["rows"])


def _swap(
    spark: SparkSession, schema: T.StructType, swap: Swap, options: LoadOptions, part: list[str], previous: str | None
) -> None:
    """Point the catalog entry at the new files. The version it replaces stays until the next load."""
    columns = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
    properties = {_CLUSTER_FIELDS: json.dumps(list(options.cluster_fields))}
    if previous:
        properties[_PREVIOUS] = previous
    if part:
        properties |= {_PARTITION_FIELD: options.partition_field, _PARTITION_UNIT: options.partition_unit}
    settings = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
    partitioned = f"PARTITIONED BY ({quoted(part[0])})" if part else ""
    # The entry is complete under another name before the old one goes.
    create = (
        f"CREATE TABLE {swap.incoming} ({columns}) USING PARQUET {partitioned} "
        f"LOCATION {literal(swap.files)} TBLPROPERTIES ({settings})"
    )
    _replace(spark, swap, create, f"MSCK REPAIR TABLE {swap.incoming}" if part else None)


def _replace(spark: SparkSession, swap: Swap, create: str, complete: str | None = None) -> None:
    """Make the new entry, let it take the table's name, and delete what nothing reads any more."""
    try:
        spark.sql(create)
        if complete:
            spark.sql(complete)
        _put_in_place(spark, swap.incoming, swap.namespace, swap.table, swap.backup)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {swap.incoming}")
        raise
    if swap.obsolete:
        delete_directory(spark, swap.obsolete)


def _put_in_place(spark: SparkSession, incoming: str, namespace: str, table: str, backup: str | None = None) -> None:
    """Give ``incoming`` the name of a table. On failure the old entry has its name again."""
    target = table_name(namespace, table)
    backup = backup or table_name(namespace, f"{table}__before_{uuid.uuid4().hex}")
    replaced = spark.catalog.tableExists(target)
    if replaced:
        _rename(spark, target, backup)
    try:
        _rename(spark, incoming, target)
    except Exception:
        if replaced:
            _rename(spark, backup, target)
        raise
    if replaced:
        try:
            spark.sql(f"DROP TABLE IF EXISTS {backup}")
        except Exception as error:  # the new table is in place; the old rows stay under the other name until the next load
            warnings.warn(f"the replaced table stays as {backup}: {error}", stacklevel=2)


_rename = rename


def create_external_table(spark: SparkSession, staged_path: str, target_root: str, namespace: str, table: str) -> str:
    """``<table>_external`` over the staged files in place; replaces an earlier one."""
    create_namespace(spark, namespace, target_root)
    name = f"{table}_external".lower()
    recover(spark, namespace, name)
    swap = Swap(namespace, name)
    with recorded(spark, swap):
        _replace(spark, swap, f"CREATE TABLE {swap.incoming} USING PARQUET LOCATION {literal(staged_path.rstrip('/'))}")
    return f"{namespace}.{name}"


def _property(spark: SparkSession, namespace: str, table: str, key: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table_name(namespace, table)}").where(F.col("key") == key).collect()
    return rows[0].value if rows else None


# --- reading targets ------------------------------------------------------------------


def read_table(spark: SparkSession, namespace: str, table: str) -> DataFrame:
    """A target table without its generated partition column."""
    existing(spark, namespace, table)
    return _without_generated(spark.table(table_name(namespace, table)))


def read_partitioned(spark: SparkSession, namespace: str, table: str, low: Any = None, high: Any = None) -> DataFrame:
    """Rows with ``low <= partition field < high``, reading only their partitions."""
    target = table_name(namespace, table)
    existing(spark, namespace, table)
    properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {target}").collect()}
    if _PARTITION_FIELD not in properties:
        raise ValueError(f"{namespace}.{table} is not partitioned")
    unit = properties[_PARTITION_UNIT]
    frame = spark.table(target)
    field = frame.schema[properties[_PARTITION_FIELD]]
    value, key = F.col(quoted(field.name)), F.col(generated_column(unit))

    def bound(limit: Any) -> Column:
        # As text: a literal datetime would pass through the time zone of the Python process.
        return F.lit(limit.isoformat() if isinstance(limit, date) else limit).cast(field.dataType)

    if low is not None:
        first = bound(low)
        frame = frame.where((value >= first) & (key >= partition_key(first, field.dataType, unit)))
    if high is not None:
        last = bound(high)
        frame = frame.where((value < last) & (key <= partition_key(last, field.dataType, unit)))
    return _without_generated(frame)


def _without_generated(frame: DataFrame) -> DataFrame:
    return frame.drop(*[c for c in frame.columns if c.startswith(GENERATED_PREFIX)])
