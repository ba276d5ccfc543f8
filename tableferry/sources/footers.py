"""Schemas of Parquet tables, read from their footers by tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import unquote, urlsplit

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tableferry.functions.type_map import source_type_name

#: Key of the schema that Spark itself puts in a footer.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

FOOTER_SCHEMA = (
    "database string, schema string, table string, table_type string, ordinal int, column_name string, data_type string, unread boolean"
)

_SAME = {
    pa.bool_(): T.BooleanType(),
    pa.int8(): T.ByteType(),
    pa.int16(): T.ShortType(),
    pa.int32(): T.IntegerType(),
    pa.int64(): T.LongType(),
    pa.float32(): T.FloatType(),
    pa.float64(): T.DoubleType(),
    pa.string(): T.StringType(),
    pa.large_string(): T.StringType(),
    pa.binary(): T.BinaryType(),
    pa.large_binary(): T.BinaryType(),
    pa.date32(): T.DateType(),
}


class Unread(Exception):
    """A footer that Spark's own reader has to judge."""


def footer_columns(tables: DataFrame) -> DataFrame:
    """A row for each column of the tables ``database, schema, table, table_type, path``.

    ``path`` is a qualified file or directory. ``unread`` marks a table, in a row without a column, that Spark's own
    reader has to open: a store that tasks cannot reach, folders that make partition columns, a type that Spark reads
    in a way of its own, no file at all.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in FOOTER_SCHEMA.split(", ")]
        for batch in batches:
            rows = []
            for *key, path in zip(*[column.to_pylist() for column in batch.columns]):
                try:
                    fields = footer_schema(path).fields
                except Exception:  # whatever it is: Spark's reader says it
                    fields = []
                if not fields:
                    rows.append((*key, None, None, None, True))
                rows += [(*key, i, f.name, source_type_name(f.dataType), False) for i, f in enumerate(fields, 1)]
            kinds = [*[pa.string()] * 4, pa.int32(), pa.string(), pa.string(), pa.bool_()]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return with_package(tables).select("database", "schema", "table", "table_type", "path").mapInArrow(read, FOOTER_SCHEMA)


def with_package(frame: DataFrame) -> DataFrame:
    """Let Python workers on this host import the package. On a cluster it is installed or sent with ``--py-files``."""
    spark: SparkSession = frame.sparkSession
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")
    return frame


def footer_schema(path: str) -> T.StructType:
    """The schema of the first file of a table, as Spark reads it."""
    files, place = _opened(path)
    with files.open_input_file(_first_file(files, place)) as file:
        footer = pq.read_metadata(file)
    known = (footer.metadata or {}).get(_SPARK_SCHEMA)
    if known is not None:
        return T.StructType.fromJson(json.loads(known))
    physical = [footer.schema.column(i).physical_type for i in range(len(footer.schema))]
    if "INT96" in physical:
        raise Unread
    return T.StructType([T.StructField(f.name, _spark_type(f.type)) for f in footer.schema.to_arrow_schema()])


def _opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parts.path) if parts.scheme else path
    return pyarrow.fs.FileSystem.from_uri(path)


def _first_file(files: pyarrow.fs.FileSystem, place: str) -> str:
    info = files.get_file_info(place)
    if info.type == pyarrow.fs.FileType.File:
        return place
    inside = [f for f in files.get_file_info(pyarrow.fs.FileSelector(place)) if not f.base_name.startswith((".", "_"))]
    if not inside or any(f.type != pyarrow.fs.FileType.File for f in inside):
        raise Unread
    return min(f.path for f in inside)


def _spark_type(kind: pa.DataType) -> T.DataType:
    if kind in _SAME:
        return _SAME[kind]
    if pa.types.is_dictionary(kind):
        return _spark_type(kind.value_type)
    if pa.types.is_decimal128(kind):
        return T.DecimalType(kind.precision, kind.scale)
    if pa.types.is_timestamp(kind) and kind.unit in ("ms", "us"):
        return T.TimestampType() if kind.tz else T.TimestampNTZType()
    if pa.types.is_map(kind):
        return T.MapType(_spark_type(kind.key_type), _spark_type(kind.item_type))
    if pa.types.is_list(kind) or pa.types.is_large_list(kind):
        return T.ArrayType(_spark_type(kind.value_type))
    if pa.types.is_struct(kind):
        return T.StructType([T.StructField(f.name, _spark_type(f.type)) for f in kind])
    raise Unread
