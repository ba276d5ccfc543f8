from __future__ import annotations

import datetime
from glob import glob
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tableferry.operators.export import (
    ColumnMapping,
    column_mappings,
    custom_selection,
    export_frame,
    export_projection,
    export_table,
    first_rows,
    ordered_sample,
)
from tableferry.sources.tables import catalog_source


def test_projection_renames_and_casts(spark):
    source = spark.sql("SELECT 1 AS ID, 'n' AS NAME, timestamp '2024-01-01 12:00:00' AS CREATED_AT, 'p' AS `user.profile.name`")
    columns = [
        ColumnMapping("ID", "NUMBER", "id"),
        ColumnMapping("NAME", "VARCHAR", "name"),
        ColumnMapping("CREATED_AT", "TIMESTAMP_TZ", "created_at"),
        ColumnMapping("user.profile.name", "VARCHAR", "user_profile_name"),
    ]
    found = export_projection(source, columns)
    assert [f.simpleString() for f in found.schema.fields] == [
        "id:int", "name:string", "created_at:timestamp_ntz", "user_profile_name:string",
    ]
    uncast = export_projection(source, columns, cast_zoned_timestamps=False)
    assert uncast.schema["created_at"].dataType.simpleString() == "timestamp"


def test_zoned_timestamps_keep_the_wall_clock(spark):
    written = spark.sql("SELECT '2024-01-01 12:00:00+09:00' AS t")
    found = export_projection(written, [ColumnMapping("t", "TIMESTAMP_TZ", "t")]).first()
    assert found.t == datetime.datetime(2024, 1, 1, 12)
    untouched = export_projection(written, [ColumnMapping("t", "TIMESTAMP_TZ(9)", "t")]).first()
    assert untouched.t == "2024-01-01 12:00:00+09:00"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instant = spark.sql("SELECT timestamp '2024-01-01 12:00:00Z' AS t")
        found = export_projection(instant, [ColumnMapping("t", "TIMESTAMP_LTZ", "t")]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found.t == datetime.datetime(2024, 1, 1, 7)


def test_custom_selection_names_come_from_the_plan(spark):
    source = spark.range(1)
    select = "SELECT id AS `customer.id`, id AS `order date`, id AS `user@email`, id AS `valid from`, id + 1, id AS `Valid-From` FROM {source}"
    assert custom_selection(spark, select, source).columns == [
        "customer_id", "order_date", "user_email", "valid_from", "_id_1", "valid_from_2",
    ]


def test_export_counts_what_it_wrote_and_leaves_nothing_stale(spark, lineitem, tmp_path):
    path = str(tmp_path / "t")
    whole = lineitem.repartition(5)
    assert export_table(whole, column_mappings(lineitem), path).rows == 6000
    assert all(name.endswith(".snappy.parquet") for name in glob(f"{path}/*.parquet"))
    assert export_frame(lineitem.limit(7), path).rows == 7
    assert spark.read.parquet(path).count() == 7


def test_export_of_an_empty_table(spark, lineitem, tmp_path):
    path = str(tmp_path / "t")
    assert export_table(lineitem.where("false"), column_mappings(lineitem), path).rows == 0
    assert spark.read.parquet(path).columns == lineitem.columns


@pytest.mark.parametrize("target", ["a/t", "a/t/", "a", ""])
def test_export_refuses_its_own_source(spark, tmp_path, target):
    source = str(tmp_path / "a" / "t")
    spark.range(10).write.parquet(source)
    with pytest.raises(ValueError, match="own source"):
        export_frame(spark.read.parquet(source), f"{tmp_path}/{target}")
    assert spark.read.parquet(source).count() == 10
    assert export_frame(spark.read.parquet(source), f"{source}_copy").rows == 10


def test_types_without_a_parquet_form_become_text(spark, tmp_path):
    frame = spark.sql("SELECT time '12:00:00.5' AS t, make_interval(0, 1, 0, 2) AS i, null AS n")
    row = spark.read.parquet(export_frame(frame, str(tmp_path / "t")).path).first()
    assert (row.t, row.n) == ("12:00:00.5", None)
    assert "2 days" in row.i


def test_sample_reads_only_the_files_it_needs(spark, lineitem, tmp_path):
    source = str(tmp_path / "many")
    lineitem.repartition(12).write.parquet(source)
    sample = first_rows(spark.read.parquet(source), 100)
    assert sample.count() == 100
    # With all but the chosen files gone the sample still reads: the others are never opened.
    chosen = {r.f for r in spark.read.parquet(source).select(F.col("_metadata.file_name").alias("f")).take(100)}
    for file in Path(source).glob("*.parquet"):
        if file.name not in chosen:
            file.unlink()
    assert sample.agg(F.sum("l_quantity")).first()[0] > 0


def test_sample_of_a_query_and_of_a_small_table(spark, lineitem):
    joined = lineitem.join(lineitem.select("l_orderkey").distinct(), "l_orderkey")
    assert first_rows(joined, 10).count() == 10
    assert first_rows(lineitem.limit(3), 100).count() == 3


def test_ordered_sample_is_a_top_k(spark, lineitem):
    plan = ordered_sample(lineitem, 100)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_catalog_source_quotes_names(spark, namespace, tmp_path):
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{tmp_path}/db'")
    spark.range(3).write.option("path", f"{tmp_path}/t").saveAsTable(f"{namespace}.`select`")
    assert catalog_source(spark)("ignored", namespace, "select").count() == 3
    assert catalog_source(spark, three_level=True)("spark_catalog", namespace, "select").count() == 3
