from __future__ import annotations

import datetime
import json
from glob import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.operators import load
from tableferry.operators.load import (
    BYTES_PER_TASK,
    POSITION,
    LoadOptions,
    check_options,
    create_external_table,
    enforce_schema,
    lay_out,
    load_table,
    parse_schema,
    partition_key,
    read_partitioned,
    read_table,
    table_name,
)
from tableferry.operators.validation import target_row_count


@pytest.fixture
def staged(tmp_path):
    def stage(frame, name="stage"):
        path = str(tmp_path / name)
        frame.write.mode("overwrite").parquet(path)
        return path

    return stage


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


# --- user schemas ---------------------------------------------------------------------


def test_schema_template():
    template = [
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "name", "type": "string"},
        {"name": "created_at", "type": "TIMESTAMP", "mode": "NULLABLE"},
    ]
    expected = [("id", "INTEGER", "REQUIRED"), ("name", "STRING", "NULLABLE"), ("created_at", "TIMESTAMP", "NULLABLE")]
    assert parse_schema(json.dumps(template)) == parse_schema(template) == expected


@pytest.mark.parametrize(
    "schema",
    [
        "not json",
        '{"name": "id"}',
        [{"name": "id"}],
        [{"type": "STRING"}],
        ["id"],
        [{"name": "id", "type": "NOPE"}],
        [{"name": "id", "type": "NUMERIC(40,2)"}],
        [{"name": "id", "type": "INTEGER(3)"}],
        [{"name": "r", "type": "RECORD", "fields": [{"name": "x"}]}],
        [{"name": "id", "type": "STRING", "mode": "MAYBE"}],
        [{"name": "id", "type": "STRING"}, {"name": "ID", "type": "STRING"}],
    ],
)
def test_bad_schemas(schema):
    with pytest.raises(ValueError):
        parse_schema(schema)


def test_enforce_types(spark):
    source = spark.sql(
        """SELECT 1 AS i, 1.5D AS n, '{"a": [1]}' AS j, array(1) AS k, timestamp_ntz '2024-01-01 00:00:00' AS t,
                  timestamp_ntz '2024-01-01 00:00:00' AS d, array(1, 2) AS r, X'78' AS b"""
    )
    fields = {"b": "BYTES", "r": "INTEGER", "d": "DATETIME", "t": "TIMESTAMP", "k": "JSON", "j": "JSON", "n": "NUMERIC", "i": "INTEGER"}
    schema = [{"name": n, "type": t, "mode": "REPEATED" if n == "r" else "NULLABLE"} for n, t in fields.items()]
    found = enforce_schema(source, schema)
    assert [f.simpleString() for f in found.schema.fields] == [
        "b:binary", "r:array<bigint>", "d:timestamp_ntz", "t:timestamp", "k:array<int>", "j:variant", "n:decimal(38,9)", "i:bigint",
    ]
    assert found.count() == 1


def test_decimals_and_records(spark):
    inner = [{"name": "x", "type": "numeric(10, 2)"}, {"name": "y", "type": "STRING(20)", "mode": "REPEATED"}]
    fields = {"a": "NUMERIC(10,2)", "b": "DECIMAL", "c": "BIGNUMERIC", "d": "BIGNUMERIC(5)"}
    schema = [{"name": n, "type": t} for n, t in fields.items()] + [{"name": "r", "type": "RECORD", "fields": inner}]
    source = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS c, 4 AS d, named_struct('y', array('p'), 'x', 5) AS r")
    found = enforce_schema(source, schema)
    assert [f.simpleString() for f in found.schema.fields] == [
        "a:decimal(10,2)", "b:decimal(38,9)", "c:decimal(38,18)", "d:decimal(5,0)", "r:struct<x:decimal(10,2),y:array<string>>",
    ]
    assert found.first().r.y == ["p"]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_values_that_do_not_fit_fail(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for sql, type_name in [("1e30D", "NUMERIC"), ("'x'", "INTEGER"), ("1e30D", "INTEGER")]:
            with pytest.raises(Exception, match="(?i)overflow|out_of_range|invalid_column_or_field"):
                enforce_schema(spark.sql(f"SELECT {sql} AS v"), [{"name": "v", "type": type_name}]).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_required_is_checked_on_the_data(spark):
    schema = [{"name": "v", "type": "INTEGER", "mode": "REQUIRED"}]
    frame = spark.createDataFrame([(1,), (None,)], "v long")
    assert enforce_schema(frame.where("v IS NOT NULL"), schema).count() == 1
    with pytest.raises(Exception, match="null in required field v"):
        enforce_schema(frame, schema).collect()
    with pytest.raises(ValueError, match="not in the data"):
        enforce_schema(frame.withColumnRenamed("v", "w"), schema)


# --- layout ---------------------------------------------------------------------------

SCHEMA = (
    T.StructType().add("ts", "timestamp_ntz").add("at", "timestamp").add("day", "date")
    .add("k", "long").add("s", "string").add("v", T.VariantType())
)


@pytest.mark.parametrize(
    "options",
    [
        LoadOptions(partition_field="ts", partition_unit="WEEK"),
        LoadOptions(partition_unit="MINUTE"),
        LoadOptions(partition_field="k"),
        LoadOptions(partition_field="missing"),
        LoadOptions(partition_field="day", partition_unit="HOUR"),
        LoadOptions(cluster_fields=("k", "K")),
        LoadOptions(cluster_fields=("k", "missing")),
        LoadOptions(cluster_fields=("ts", "at", "day", "k", "s")),
    ],
)
def test_bad_layouts(options):
    with pytest.raises(ValueError):
        check_options(SCHEMA, options)


def test_good_layouts():
    found = check_options(SCHEMA, LoadOptions(partition_field="TS", cluster_fields=("S", "K")))
    assert (found.partition_field, found.cluster_fields) == ("ts", ("s", "k"))
    for field, unit in [("ts", "HOUR"), ("AT", "DAY"), ("day", "MONTH"), ("day", "YEAR")]:
        check_options(SCHEMA, LoadOptions(partition_field=field, partition_unit=unit, cluster_fields=("k", "S")))
    with pytest.raises(ValueError, match="reserved"):
        check_options(T.StructType().add("__p_day", "string"), LoadOptions())


def test_partition_keys_ignore_the_time_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # 02:30 does not exist there on this day
        frame = spark.sql("SELECT timestamp_ntz '2024-03-10 02:30:00' AS t")
        keys = frame.select(*[partition_key(F.col("t"), T.TimestampNTZType(), u).alias(u) for u in load.PARTITION_UNITS]).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(keys) == ("2024031002", "20240310", "202403", "2024")


def test_years_beyond_four_digits_fail(spark):
    frame = spark.sql("SELECT make_date(y, 1, 1) AS d FROM VALUES (1), (9999), (null), (10000) AS t(y)")
    key = partition_key(F.col("d"), T.DateType(), "YEAR").alias("k")
    assert [r.k for r in frame.where("d < '9999-12-31' OR d IS NULL").select(key).collect()] == ["0001", "9999", None]
    with pytest.raises(Exception, match="beyond 9999"):
        frame.select(key).collect()


def test_plain_load_has_no_shuffle(spark, lineitem):
    assert "Exchange" not in plan_of(lay_out(lineitem, LoadOptions(), 0))


def test_hot_partition_is_split(spark, lineitem, tmp_path):
    staged = str(tmp_path / "stage")
    lineitem.withColumn("l_shipdate", F.lit("2000-01-01").cast("timestamp_ntz")).repartition(8).write.parquet(staged)
    staged_rows = load.with_position(spark.read.parquet(staged))
    frame = lay_out(staged_rows, LoadOptions(partition_field="l_shipdate"), 20 * BYTES_PER_TASK)
    assert POSITION not in frame.columns and "_slices" not in frame.columns
    frame.write.partitionBy("__p_day").parquet(str(tmp_path / "out"))
    assert len(glob(f"{tmp_path}/out/__p_day=20000101/*.parquet")) > 8


def test_copies_of_one_row_are_split_by_clustering(spark, lineitem, tmp_path):
    staged = str(tmp_path / "stage")
    copies = lineitem.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20000)))).drop("n")
    copies.repartition(4).write.parquet(staged)
    position = F.struct("_metadata.file_name", "_metadata.row_index").alias(POSITION)
    frame = lay_out(spark.read.parquet(staged).select("*", position), LoadOptions(cluster_fields=("l_suppkey",)), 10 * BYTES_PER_TASK)
    sizes = [r["count"] for r in frame.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * min(sizes)


def test_tasks_grow_with_the_staged_bytes(spark):
    sizes = [0, 3 * load.MIB, 100 * BYTES_PER_TASK, 10**6 * BYTES_PER_TASK]
    assert [load.shuffle_tasks(spark, s) for s in sizes] == [8, 8, 100, 10**6]


def shuffled_columns(frame) -> list[str]:
    """The columns that the shuffle below the frame carries."""
    node = frame._jdf.queryExecution().sparkPlan()
    while node.nodeName() != "Exchange":
        node = node.children().head()
    return [name.rsplit("#", 1)[0] for name in node.output().mkString("\n").split("\n")]


@pytest.mark.parametrize("clusters", [(), ("l_suppkey",)])
def test_a_shuffle_carries_one_number_beside_the_rows(spark, lineitem, staged, clusters):
    rows = load.with_position(spark.read.parquet(staged(lineitem)))
    frame = lay_out(rows, LoadOptions(partition_field="l_shipdate", partition_unit="MONTH", cluster_fields=clusters), 0)
    extra = [c for c in shuffled_columns(frame) if c not in lineitem.columns]
    assert sorted(extra) == sorted(["__p_month", POSITION if clusters else "_task"])


@pytest.mark.parametrize("options", [{"partition_field": "l_shipdate"}, {"cluster_fields": ("l_suppkey",)}])
def test_tasks_grow_with_the_rows_that_a_task_sorts(spark, lineitem, staged, namespace, tmp_path, monkeypatch, options):
    monkeypatch.setattr(load, "ROW_BYTES_PER_TASK", 64_000)  # the 6000 rows take some MB but few bytes as Parquet
    seen, lay = [], load.lay_out

    def laid_out(*args):
        seen.append(lay(*args))
        return seen[-1]

    monkeypatch.setattr(load, "lay_out", laid_out)
    assert load_table(spark, staged(lineitem), str(tmp_path), namespace, "t", LoadOptions(**options)).rows == 6000
    sizes = [r["count"] for r in seen[0].groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) > 8 and sum(sizes) == 6000
    assert read_table(spark, namespace, "t").exceptAll(lineitem).isEmpty()


# --- tables ---------------------------------------------------------------------------


def test_partitioned_and_clustered_load(spark, lineitem, staged, namespace, tmp_path):
    options = LoadOptions(partition_field="l_shipdate", partition_unit="MONTH", cluster_fields=("l_suppkey", "l_partkey"))
    result = load_table(spark, staged(lineitem), str(tmp_path), namespace, "t", options)
    assert (result.target, result.rows) == (f"{namespace}.t", 6000)
    found = read_table(spark, namespace, "t")
    assert found.columns == lineitem.columns
    assert found.exceptAll(lineitem).isEmpty() and lineitem.exceptAll(found).isEmpty()
    assert spark.table(f"{namespace}.t").schema["__p_month"].dataType == T.StringType()
    for (file,) in spark.table(f"{namespace}.t").select("_metadata.file_path").distinct().take(3):
        rows = [(r.l_suppkey, r.l_partkey) for r in spark.read.parquet(file).collect()]
        assert rows == sorted(rows)


def test_range_reads_only_its_partitions(spark, events, staged, namespace, tmp_path):
    late = events.where("ts >= '2024-01-10 06:00:00' AND ts < '2024-01-12'")
    load_table(spark, staged(events), str(tmp_path), namespace, "t", LoadOptions(partition_field="TS"))
    found = read_partitioned(spark, namespace, "t", datetime.datetime(2024, 1, 10, 6), datetime.datetime(2024, 1, 12))
    assert found.exceptAll(late).isEmpty() and found.count() == late.count()
    days = {p.split("__p_day=")[1][:8] for p in found.inputFiles()}
    filters = plan_of(found).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert ">= 20240110" in filters and "<= 20240112" in filters
    assert days >= {"20240110", "20240111"}
    assert read_partitioned(spark, namespace, "t").count() == events.count()
    load_table(spark, staged(events), str(tmp_path), namespace, "plain")
    with pytest.raises(ValueError, match="not partitioned"):
        read_partitioned(spark, namespace, "plain")


def test_instants_are_read_alike_in_every_time_zone(spark, staged, namespace, tmp_path):
    hours = spark.range(72).selectExpr("timestamp_seconds(1709900000 + id * 3600) AS at", "id")
    path = staged(hours)
    low, high = "2024-03-09T12:00:00Z", datetime.datetime(2024, 3, 10, 12, tzinfo=datetime.UTC)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        load_table(spark, path, str(tmp_path), namespace, "t", LoadOptions(partition_field="at"))
        there = {r.id for r in read_partitioned(spark, namespace, "t", low, high).collect()}
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        here = {r.id for r in read_partitioned(spark, namespace, "t", low, high).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = {r.id for r in hours.where("at >= '2024-03-09 12:00:00' AND at < '2024-03-10 12:00:00'").collect()}
    assert there == here == expected and len(expected) == 24


def test_null_partition_values_survive(spark, staged, namespace, tmp_path):
    frame = spark.sql("SELECT * FROM VALUES (1, date '2024-02-03'), (2, null) AS t(k, day)")
    load_table(spark, staged(frame), str(tmp_path), namespace, "t", LoadOptions(partition_field="day", partition_unit="YEAR"))
    assert {tuple(r) for r in read_table(spark, namespace, "t").collect()} == {(1, datetime.date(2024, 2, 3)), (2, None)}


def test_a_failed_load_leaves_the_old_table(spark, staged, namespace, tmp_path):
    load_table(spark, staged(spark.range(5)), str(tmp_path), namespace, "t")
    bad = staged(spark.createDataFrame([(1,), (None,)], "id long"), "bad")
    required = LoadOptions(custom_schema=[{"name": "id", "type": "INTEGER", "mode": "REQUIRED"}])
    for options in (required, LoadOptions(partition_field="id")):
        with pytest.raises(Exception):
            load_table(spark, bad, str(tmp_path), namespace, "t", options)
    assert read_table(spark, namespace, "t").count() == 5
    assert len(glob(f"{tmp_path}/{namespace}/t/v-*")) == 1


@pytest.mark.parametrize("failing", ["incoming", "target"])
def test_a_failed_rename_keeps_the_old_table(spark, staged, namespace, tmp_path, monkeypatch, failing):
    load_table(spark, staged(spark.range(5)), str(tmp_path), namespace, "t")
    rename = load._rename

    def broken(spark, old, new):
        if (new if failing == "incoming" else old) == table_name(namespace, "t") and "before" not in old:
            raise RuntimeError("no rename")
        rename(spark, old, new)

    monkeypatch.setattr(load, "_rename", broken)
    with pytest.raises(RuntimeError, match="no rename"):
        load_table(spark, staged(spark.range(9), "b"), str(tmp_path), namespace, "t")
    with pytest.raises(RuntimeError, match="no rename"):
        load._put_in_place(spark, table_name(namespace, "none"), namespace, "t")
    assert read_table(spark, namespace, "t").count() == 5
    assert len(glob(f"{tmp_path}/{namespace}/t/v-*")) == 1
    assert [t.name for t in spark.catalog.listTables(namespace)] == ["t"]


def test_a_failed_drop_keeps_both_versions(spark, staged, namespace, tmp_path, monkeypatch):
    load_table(spark, staged(spark.range(5)), str(tmp_path), namespace, "t")
    real = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.startswith("DROP TABLE") and "before" in text:
            raise RuntimeError("no drop")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.warns(UserWarning, match="no drop"):
        load_table(spark, staged(spark.range(9), "b"), str(tmp_path), namespace, "t")
    assert read_table(spark, namespace, "t").count() == 9
    old = next(t.name for t in spark.catalog.listTables(namespace) if "before" in t.name)
    assert spark.table(table_name(namespace, old)).count() == 5


def test_the_replaced_version_stays_until_the_next_load(spark, staged, namespace, tmp_path):
    for n, kept in ((3, 1), (4, 2), (5, 2)):
        load_table(spark, staged(spark.range(n), f"s{n}"), str(tmp_path), namespace, "t")
        assert len(glob(f"{tmp_path}/{namespace}/t/v-*")) == kept
    assert read_table(spark, namespace, "t").count() == 5


def test_a_column_named_metadata(spark, staged, namespace, tmp_path):
    frame = spark.sql("SELECT id AS _metadata, DATE'2024-01-01' + CAST(id % 3 AS INT) AS day FROM range(9)")
    options = LoadOptions(partition_field="day", cluster_fields=("_metadata",))
    assert load_table(spark, staged(frame), str(tmp_path), namespace, "t", options).rows == 9
    assert read_table(spark, namespace, "t").columns == ["_metadata", "day"]


def test_a_load_replaces_schema_layout_and_files(spark, events, staged, namespace, tmp_path):
    assert target_row_count(spark, namespace, "t") == 0
    load_table(spark, staged(events), str(tmp_path), namespace, "t", LoadOptions(partition_field="ts"))
    assert target_row_count(spark, namespace, "t") == 1000
    named = LoadOptions(custom_schema=[{"name": "Location", "type": "INTEGER"}])
    load_table(spark, staged(spark.range(5).toDF("location"), "other"), str(tmp_path), namespace, "t", named)
    load_table(spark, staged(spark.range(5), "other"), str(tmp_path), namespace, "t")
    assert read_table(spark, namespace, "t").columns == ["id"]
    assert target_row_count(spark, namespace, "t") == 5
    assert len(glob(f"{tmp_path}/{namespace}/t/v-*")) == 2
    assert [t.name for t in spark.catalog.listTables(namespace)] == ["t"]


def test_nested_and_awkward_columns(spark, staged, namespace, tmp_path):
    frame = spark.sql("SELECT named_struct('a b', 1, 'c', array(map('k', 2))) AS `x``y z`, parse_json('{\"q\": 1}') AS v")
    load_table(spark, staged(frame), str(tmp_path), namespace, "t")
    assert read_table(spark, namespace, "t").schema == frame.schema or read_table(spark, namespace, "t").count() == 1


def test_external_table_reads_in_place_and_is_replaced(spark, staged, namespace, tmp_path):
    create_external_table(spark, staged(spark.range(3), "a"), str(tmp_path), namespace, "T")
    target = create_external_table(spark, staged(spark.range(7), "b"), str(tmp_path), namespace, "T")
    assert target == f"{namespace}.t_external"
    assert spark.table(target).count() == 7
    spark.sql(f"DROP TABLE {table_name(namespace, 't_external')}")
    assert spark.read.parquet(f"{tmp_path}/b").count() == 7


@pytest.mark.parametrize("shape", ["hot", "many", "nulls", "one"])
def test_slices_are_placed_evenly(spark, shape):
    day = {
        "hot": "IF(id % 3 = 0, date'2024-01-05', date'2024-01-01' + int(id % 400))",
        "many": "date'1990-01-01' + int(id % 9000)",
        "nulls": "IF(id % 2 = 0, NULL, date'2024-01-01' + int(id % 7))",
        "one": "date'2024-01-01'",
    }[shape]
    rows = spark.range(40_000).selectExpr(f"{day} AS day", "id", f"struct('f' AS file_name, id AS row_index) AS {POSITION}")
    frame = lay_out(rows, LoadOptions(partition_field="day"), 16 * BYTES_PER_TASK)
    assert sorted(frame.columns) == ["__p_day", "day", "id"]
    dealt = frame.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n"), F.count_distinct("__p_day").alias("days"))
    found = dealt.collect()
    assert len(found) == 16 and sum(r.n for r in found) == 40_000
    assert max(r.n for r in found) <= 1.5 * 40_000 / 16 + 50
    if shape == "many":  # a task has neighbouring partitions, and few are in two tasks
        assert sum(r.days for r in found) <= 9000 + 16


def test_ranges_are_chosen_by_short_keys(spark, staged, namespace, tmp_path):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang", "text")
    kinds = texts.schema
    lengths = texts.select(*[F.max(F.length(k)).alias(str(i)) for i, k in enumerate(load.range_keys(kinds, ["text"]))]).first()
    assert tuple(lengths) == (load.RANGE_BYTES,)
    two = texts.select(*[F.max(F.length(k)).alias(str(i)) for i, k in enumerate(load.range_keys(kinds, ["lang", "text"]))]).first()
    assert two["1"] == load.RANGE_BYTES // 2 and two["0"] == 2
    nested = spark.sql("SELECT array('x') AS a, 1 AS n, named_struct('q', 1) AS s")
    assert [f.dataType.simpleString() for f in nested.select(*load.range_keys(nested.schema, ["a", "n", "s"])).schema] == ["bigint", "int", "bigint"]

    laid_out = lay_out(load.with_position(spark.read.parquet(staged(texts.repartition(4)))), LoadOptions(cluster_fields=("text",)), 0)
    exchange = next(line for line in plan_of(laid_out).splitlines() if "rangepartitioning(" in line)
    assert "substring(cast(text" in exchange and "xxhash64(" in exchange
    load_table(spark, f"{tmp_path}/stage", str(tmp_path), namespace, "t", LoadOptions(cluster_fields=("text",)))
    ranges = read_table(spark, namespace, "t").groupBy(F.input_file_name()).agg(F.min("text").alias("low"), F.max("text").alias("high"))
    found = sorted((r.low[:6], r.high[:6]) for r in ranges.collect())
    assert len(found) > 1 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))
