from __future__ import annotations

import pytest
from pyspark.sql import types as T

from tableferry.functions.type_map import LOGICAL_OF, logical_name, logical_type, source_type_name
from tableferry.plans.inference import infer_schema, partition_eligible, schema_json
from tableferry.sources.metadata import COLUMNS_SCHEMA

CASES = {
    "VARCHAR(255)": "STRING",
    "NUMBER(10,2)": "NUMERIC",
    "INTEGER": "INTEGER",
    "TIMESTAMP_NTZ": "TIMESTAMP",
    "TIMESTAMP_TZ(9)": "TIMESTAMP",
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "VARIANT": "JSON",
    "UNKNOWN_TYPE": "STRING",
    "double precision": "STRING",
    "double_precision": "FLOAT64",
    " number (3) ": "NUMERIC",
    "": "STRING",
}


def test_logical_type_cases(spark):
    frame = spark.createDataFrame([(t,) for t in [*CASES, None]], "t string")
    found = {r.t: r.l for r in frame.select("t", logical_type("t").alias("l")).collect()}
    assert found == {**CASES, None: "STRING"}


def test_every_source_type_is_mapped():
    assert len(LOGICAL_OF) == 34


@pytest.mark.parametrize(
    "data_type, source, logical",
    [
        (T.ByteType(), "TINYINT", "INTEGER"),
        (T.DecimalType(12, 3), "DECIMAL(12,3)", "NUMERIC"),
        (T.FloatType(), "FLOAT", "FLOAT64"),
        (T.TimestampType(), "TIMESTAMP_LTZ", "TIMESTAMP"),
        (T.TimestampNTZType(), "TIMESTAMP_NTZ", "TIMESTAMP"),
        (T.BinaryType(), "BINARY", "BYTES"),
        (T.ArrayType(T.FloatType()), "ARRAY", "JSON"),
        (T.StructType([T.StructField("a", T.LongType())]), "OBJECT", "JSON"),
        (T.DayTimeIntervalType(), "INTERVAL DAY TO SECOND", "STRING"),
    ],
)
def test_spark_types(data_type, source, logical):
    assert source_type_name(data_type) == source
    assert logical_name(data_type) == logical


def columns(spark, rows, schema=COLUMNS_SCHEMA):
    full = [("DB", "PUBLIC", "T", i, *row) for i, row in enumerate(rows, 1)]
    return spark.createDataFrame(full, schema)


def test_inference_deduplicates_names(spark):
    rows = [("", "INTEGER"), ("   ", "VARCHAR(50)"), ("user.name", "VARCHAR(255)"), ("user-name", "VARCHAR(255)"), ("USER_NAME", "VARCHAR(255)")]
    found = infer_schema(columns(spark, rows)).orderBy("ordinal").collect()
    assert [r.name for r in found] == ["_", "_2", "user_name", "user_name_2", "user_name_3"]
    assert [r.type for r in found] == ["INTEGER", "STRING", "STRING", "STRING", "STRING"]
    assert {r["mode"] for r in found} == {"NULLABLE"}


def test_inference_defaults_and_aliases(spark):
    rows = [(None, None, None), ("A", "DATE", "The Day"), ("B", "TIME", None)]
    frame = columns(spark, rows, COLUMNS_SCHEMA + ", alias string")
    inferred = infer_schema(frame)
    found = [(r.name, r.type) for r in inferred.orderBy("ordinal").collect()]
    assert found == [("column_0", "STRING"), ("the_day", "DATE"), ("b", "TIME")]
    assert [r.display for r in partition_eligible(inferred).collect()] == ["the_day (DATE)"]
    assert schema_json(inferred).first().schema_json == (
        '[{"name":"column_0","type":"STRING","mode":"NULLABLE"},'
        '{"name":"the_day","type":"DATE","mode":"NULLABLE"},'
        '{"name":"b","type":"TIME","mode":"NULLABLE"}]'
    )
