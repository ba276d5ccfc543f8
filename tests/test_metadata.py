from __future__ import annotations

import datetime
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from conftest import SF_DIR
from tableferry.sources import metadata
from tableferry.sources.footers import footer_schema
from tableferry.sources.metadata import catalog_metadata, parquet_metadata, schema_metadata
from tableferry.sources.rules import make_rules

PLAIN = pa.table({
    "a": pa.array([1], pa.int32()), "Big One": pa.array([1], pa.int64()), "t": pa.array([1], pa.int8()), "f": pa.array([1.0], pa.float32()),
    "s": ["x"], "b": pa.array([b"x"]), "ok": [True], "day": [datetime.date(2024, 1, 1)], "d": pa.array([Decimal("1.25")], pa.decimal128(12, 2)),
    "at": pa.array([0], pa.timestamp("us")), "zoned": pa.array([0], pa.timestamp("us", "UTC")), "ms": pa.array([0], pa.timestamp("ms")),
    "list": [[1, 2]], "rec": [{"x": 1, "y": ["z"]}], "map": pa.array([[("k", 1)]], pa.map_(pa.string(), pa.int32())),
    "dict": pa.array(["x"]).dictionary_encode(), "large": pa.array(["x"], pa.large_string()),
})


def key(name):
    return ("WH", "PUBLIC", name)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Tables that footers tell of, and odd ones."""
    root = tmp_path_factory.mktemp("tables")
    paths = {}
    for i in range(20):
        paths[key(f"PLAIN{i}")] = f"{root}/plain{i}.parquet"
        pq.write_table(PLAIN.select(PLAIN.column_names[i % 5 :]), f"{root}/plain{i}.parquet")
    spaced = f"{root}/a folder%20here"
    spark.sql("SELECT 1 AS `x y`, current_timestamp() AS now, timestamp_ntz'2024-01-01' AS wall, named_struct('q', 1) AS n").write.parquet(spaced)
    paths[key("SPARK")] = spaced
    for name in ("events", "orders", "lineitem", "documents", "embeddings"):
        paths[key(name.upper())] = f"{SF_DIR}/{name}.parquet"
    odd = {}
    spark.range(3).selectExpr("id", "date'2024-01-01' AS day").write.partitionBy("day").parquet(f"{root}/parts")
    odd[key("PARTS")] = f"{root}/parts"
    pq.write_table(pa.table({"u": pa.array([1], pa.uint32()), "v": pa.array([1], pa.uint64())}), f"{root}/unsigned.parquet")
    odd[key("UNSIGNED")] = f"{root}/unsigned.parquet"
    pq.write_table(pa.table({"t": pa.array([0], pa.timestamp("us"))}), f"{root}/int96.parquet", use_deprecated_int96_timestamps=True)
    odd[key("INT96")] = f"{root}/int96.parquet"
    (root / "text.parquet").write_text("no footer")
    odd[key("TEXT")] = f"{root}/text.parquet"
    odd[key("GONE")] = f"{root}/gone"
    return paths, odd


def contents(found):
    parts = found.tables, found.columns
    return [sorted((tuple(r[c] for c in sorted(p.columns)) for p in [part] for r in p.collect()), key=repr) for part in parts] + [
        sorted(r.table for r in found.errors.collect())
    ]


def test_footers_tell_what_spark_reads(spark, files):
    for path in files[0].values():
        found, expected = footer_schema(metadata.qualified(spark, path)), spark.read.parquet(path).schema
        assert [(f.name, f.dataType.simpleString()) for f in found] == [(f.name, f.dataType.simpleString()) for f in expected]


def test_tasks_read_what_the_driver_would(spark, files, monkeypatch):
    plain, odd = files
    paths = {**plain, **odd}
    by_driver = contents(parquet_metadata(spark, paths, views=[key("SPARK")]))
    opened, real = [], metadata.schema_metadata

    def schemas(spark, entries, read, *rest):
        opened.extend(k for k, _ in entries)
        return real(spark, entries, read, *rest)

    monkeypatch.setattr(metadata, "schema_metadata", schemas)
    monkeypatch.setattr(metadata, "BATCH", 7)
    by_tasks = contents(parquet_metadata(spark, paths, views=[key("SPARK")]))
    assert by_tasks == by_driver
    # No table passes the driver but those that only Spark's reader understands.
    assert sorted(opened) == sorted(odd)
    assert by_tasks[2] == ["GONE", "TEXT"]


@pytest.mark.parametrize("n", [0, 1, 5, 6])
def test_a_catalog_is_written_in_batches(spark, files, monkeypatch, n):
    entries = [(k, "BASE TABLE") for k in [*files[0], *files[1]][-n:]] if n else []
    read = lambda k: spark.read.parquet({**files[0], **files[1]}[k]).schema
    whole = contents(schema_metadata(spark, entries, read))
    monkeypatch.setattr(metadata, "BATCH", 2)
    held, real = [], metadata._frames
    monkeypatch.setattr(metadata, "_frames", lambda spark, scanned: held.append(rows := list(scanned)) or real(spark, rows))
    assert contents(schema_metadata(spark, entries, read)) == whole
    assert max(map(len, held), default=0) <= 2


def test_schemas_that_no_rule_names_are_not_listed(spark, namespace, tmp_path, monkeypatch):
    others = [f"{namespace}_{i}" for i in range(3)]
    for name in (namespace, *others):
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
        spark.sql(f"CREATE TABLE {name}.t (x INT) USING parquet")
    spark.sql(f"CREATE VIEW {namespace}.v AS SELECT 1 AS y")
    said, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or real(self, text, *a, **k))
    rules = make_rules(spark, [{"database": "spark_catalog", "schema": namespace, "with_views": True}, {"database": "spark_catalog", "schema": others[0], "table": "T"}])
    found = catalog_metadata(spark, rules=rules)
    expected = {(namespace.upper(), "T", "BASE TABLE"), (namespace.upper(), "V", "VIEW"), (others[0].upper(), "T", "BASE TABLE")}
    assert {(r.schema, r.table, r.table_type) for r in found.tables.collect()} == expected
    listed = {text.rsplit(" ", 1)[1].split(".")[1].strip("`") for text in said if text.startswith("SHOW TABLES")}
    assert listed == {namespace, others[0]}
    assert not any(other in text for text in said for other in others[1:])
