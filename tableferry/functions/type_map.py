"""Type vocabulary: source type name -> logical target type -> Spark type."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.functions.names import strip_whitespace

# The logical target type of each source type name.
LOGICAL_OF = {
    "NUMBER": "NUMERIC",
    "DECIMAL": "NUMERIC",
    "NUMERIC": "NUMERIC",
    "INT": "INTEGER",
    "INTEGER": "INTEGER",
    "BIGINT": "INTEGER",
    "SMALLINT": "INTEGER",
    "TINYINT": "INTEGER",
    "BYTEINT": "INTEGER",
    "FLOAT": "FLOAT64",
    "FLOAT4": "FLOAT64",
    "FLOAT8": "FLOAT64",
    "DOUBLE": "FLOAT64",
    "DOUBLE_PRECISION": "FLOAT64",
    "REAL": "FLOAT64",
    "VARCHAR": "STRING",
    "CHAR": "STRING",
    "CHARACTER": "STRING",
    "STRING": "STRING",
    "TEXT": "STRING",
    "BINARY": "BYTES",
    "VARBINARY": "BYTES",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "DATETIME": "DATETIME",
    "TIME": "TIME",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP_LTZ": "TIMESTAMP",
    "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ": "TIMESTAMP",
    "VARIANT": "JSON",
    "OBJECT": "JSON",
    "ARRAY": "JSON",
    "GEOGRAPHY": "GEOGRAPHY",
}
DEFAULT_LOGICAL = "STRING"

# Source types exported as wall-clock timestamps, and the logical
# types a table can be partitioned on.
ZONED_TIMESTAMPS = ("TIMESTAMP_TZ", "TIMESTAMP_LTZ")
TEMPORAL_TYPES = ("DATE", "DATETIME", "TIMESTAMP")

# Spark type stored for each type name a user schema may use. TIME and GEOGRAPHY
# have no Parquet form in Spark and travel as text.
SPARK_TYPES = {
    "STRING": T.StringType(),
    "BYTES": T.BinaryType(),
    "INTEGER": T.LongType(),
    "INT64": T.LongType(),
    "FLOAT": T.DoubleType(),
    "FLOAT64": T.DoubleType(),
    "NUMERIC": T.DecimalType(38, 9),
    "DECIMAL": T.DecimalType(38, 9),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "BIGDECIMAL": T.DecimalType(38, 18),
    "BOOLEAN": T.BooleanType(),
    "BOOL": T.BooleanType(),
    "DATE": T.DateType(),
    "DATETIME": T.TimestampNTZType(),
    "TIME": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "JSON": T.VariantType(),
    "GEOGRAPHY": T.StringType(),
}

_SOURCE_NAME_OF = {
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INT",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.StringType: "STRING",
    T.CharType: "CHAR",
    T.VarcharType: "VARCHAR",
    T.BinaryType: "BINARY",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP_LTZ",
    T.TimestampNTZType: "TIMESTAMP_NTZ",
    T.ArrayType: "ARRAY",
    T.MapType: "OBJECT",
    T.StructType: "OBJECT",
    T.VariantType: "VARIANT",
}


def logical_type(source_type: Column | str) -> Column:
    """Logical target type of a source type such as ``NUMBER(10,2)``.

    The name is upper-cased and cut at the first ``(``; unknown names are STRING.
    """
    text = F.col(source_type) if isinstance(source_type, str) else source_type
    key = strip_whitespace(F.substring_index(F.upper(text), "(", 1))
    lookup = F.create_map(*[F.lit(x) for pair in LOGICAL_OF.items() for x in pair])
    return F.coalesce(F.try_element_at(lookup, key), F.lit(DEFAULT_LOGICAL))


def source_type_name(data_type: T.DataType) -> str:
    """Source-vocabulary name of a Spark type, for metadata read from Spark itself."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    name = _SOURCE_NAME_OF.get(type(data_type))
    # `time(6)` -> TIME; anything without an entry keeps its Spark name, hence STRING.
    return name or data_type.simpleString().upper().split("(")[0]


def logical_name(data_type: T.DataType) -> str:
    """Logical target type of a Spark type."""
    return LOGICAL_OF.get(source_type_name(data_type).split("(")[0], DEFAULT_LOGICAL)
