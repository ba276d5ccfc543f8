from __future__ import annotations

import json

from pyspark.sql import functions as F

from tableferry.operators.selection import in_listing_order, select_tables, table_counts, table_records
from tableferry.sources.metadata import TABLES_SCHEMA, catalog_metadata, parquet_metadata, schema_metadata
from tableferry.sources.rules import make_rules, read_rules, rules_from_manifest, split_rules

from conftest import SF_DIR

TABLES = [
    ("PROD", "ANALYTICS", "SALES_DATA", "BASE TABLE"),
    ("PROD", "ANALYTICS", "SALES_VIEW", "VIEW"),
    ("PROD", "RAW", "EVENTS", "BASE TABLE"),
    ("DEV", "PUBLIC", "TMP_1", "BASE TABLE"),
    ("DEV", "PUBLIC", "TMPX", "BASE TABLE"),
    ("DEV", "PUBLIC", "A_TEMP", "BASE TABLE"),
    ("DEV", "PUBLIC", "KEPT", "BASE TABLE"),
    ("DEV", "PUBLIC", "A\\B", "BASE TABLE"),
    ("DEV", "PUBLIC", "lower", "BASE TABLE"),
]


def selected(spark, *rules):
    tables = spark.createDataFrame(TABLES, TABLES_SCHEMA)
    found = select_tables(make_rules(spark, list(rules)), tables).orderBy("rule_pos", "schema", "table").collect()
    return [(r.table, r.rule_pos, r.rule_idx) for r in found]


def names(spark, *rules):
    return sorted(name for name, _, _ in selected(spark, *rules))


def test_views_only_on_request(spark):
    assert names(spark, {"database": "prod", "schema": "analytics"}) == ["SALES_DATA"]
    assert names(spark, {"database": "PROD", "with_views": True}) == ["EVENTS", "SALES_DATA", "SALES_VIEW"]


def test_excludes_are_like_patterns(spark):
    rule = {"database": "DEV", "schema": "PUBLIC", "exclude_table_like": ["TMP_%", "%_temp", "", None]}
    # `_` is a wildcard, so TMPX goes too; rule values are upper-cased, patterns included.
    assert names(spark, rule) == ["A\\B", "KEPT", "lower"]
    assert names(spark, {"database": "PROD", "exclude_schema_like": ["r%"]}) == ["SALES_DATA"]


def test_backslash_in_a_pattern_is_literal(spark):
    assert "A\\B" not in names(spark, {"database": "DEV", "exclude_table_like": ["a\\%"]})


def test_lower_case_objects_are_not_selected_by_name(spark):
    assert names(spark, {"database": "DEV", "schema": "PUBLIC", "table": "lower"}) == []


def test_first_rule_fixes_position_last_rule_wins(spark):
    found = selected(
        spark,
        {"database": "PROD", "schema": "RAW"},
        {"database": "DEV", "schema": "PUBLIC", "table": "kept"},
        {"database": "PROD"},
    )
    assert found == [("EVENTS", 0, 2), ("KEPT", 1, 1), ("SALES_DATA", 2, 2)]


def test_invalid_rules_are_reported_and_skipped(spark):
    rules = make_rules(spark, [{"database": "PROD", "table": "important_table"}, {"schema": "PUBLIC"}, {"database": ""}, {"database": "DEV"}])
    usable, rejected = split_rules(rules)
    assert [r.rule_idx for r in usable.collect()] == [3]
    assert {r.rule_idx: r.reject_reason for r in rejected.collect()} == {
        0: "'schema' is mandatory if 'table' is provided",
        1: "'database' is mandatory",
        2: "'database' is mandatory",
    }


def test_rules_from_json(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps({"rule_idx": 0, "database": "PROD", "exclude_table_like": ["E%"]}) + "\n")
    rule = read_rules(spark, str(path)).first()
    assert (rule.database, rule.schema, rule.exclude_table_like, rule.with_views) == ("PROD", None, ["E%"], None)


def test_unreadable_table_does_not_hide_others(spark):
    paths = {("WH", "P", "ORDERS"): f"{SF_DIR}/orders.parquet", ("WH", "P", "GONE"): f"{SF_DIR}/gone.parquet"}
    found = parquet_metadata(spark, paths)
    assert [r.table for r in found.tables.collect()] == ["ORDERS"]
    assert [r.table for r in found.errors.collect()] == ["GONE"]
    assert [r.column_name for r in found.columns.orderBy("ordinal").collect()][:2] == ["o_orderkey", "o_custkey"]


def test_catalog_metadata(spark, namespace, tmp_path):
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{tmp_path}/db'")
    spark.range(3).write.option("path", f"{tmp_path}/t").saveAsTable(f"{namespace}.t")
    spark.sql(f"CREATE VIEW {namespace}.v AS SELECT id, timestamp '2024-01-01' AS at FROM {namespace}.t")
    found = catalog_metadata(spark, ["no_such_schema", namespace])
    assert [(r.schema, r.table) for r in found.errors.collect()] == [("NO_SUCH_SCHEMA", None)]
    assert {(r.table, r.table_type) for r in found.tables.collect()} == {("T", "BASE TABLE"), ("V", "VIEW")}
    record = table_records(found.columns).where("table = 'V'").first()
    assert [(c.column_name, c.data_type) for c in record["columns"]] == [("id", "BIGINT"), ("at", "TIMESTAMP_LTZ")]


def test_rules_open_only_what_they_select(spark, namespace, tmp_path, monkeypatch):
    spark.sql(f"CREATE DATABASE {namespace} LOCATION '{tmp_path}/db'")
    for name in ("a", "b"):
        spark.range(3).write.option("path", f"{tmp_path}/{name}").saveAsTable(f"{namespace}.{name}")
    opened = []
    read = type(spark).table
    monkeypatch.setattr(type(spark), "table", lambda self, name: opened.append(name) or read(self, name))
    rules = make_rules(spark, [{"database": "spark_catalog", "schema": namespace, "exclude_table_like": ["A"]}])
    found = catalog_metadata(spark, rules=rules)
    assert [(r.schema, r.table) for r in found.tables.collect()] == [(namespace.upper(), "B")]
    assert [n for n in opened if namespace in n] == [f"`spark_catalog`.`{namespace}`.`b`"]


def test_an_error_without_a_message_does_not_hide_others(spark):
    def read(key):
        if key[2] == "BAD":
            raise RuntimeError
        return spark.range(1).schema

    found = schema_metadata(spark, [(("D", "S", "BAD"), "BASE TABLE"), (("D", "S", "OK"), "BASE TABLE")], read)
    assert [r.error for r in found.errors.collect()] == ["RuntimeError"] and [r.table for r in found.tables.collect()] == ["OK"]


def test_exact_rules_join_on_all_names(spark):
    tables = spark.range(1000).select(F.lit("D").alias("database"), F.lit("S").alias("schema"), F.concat(F.lit("T"), "id").alias("table"), F.lit("BASE TABLE").alias("table_type"))
    manifest = tables.where("table < 'T5'")
    selected = select_tables(rules_from_manifest(manifest), tables)
    plan = selected._jdf.queryExecution().optimizedPlan().toString() + selected._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join Cross" not in plan
    assert selected.count() == manifest.count()


def test_columns_are_listed_in_order(spark):
    rows = [("D", "B", "T", 1, "X", "INT"), ("D", "A", "U", 2, "Y", "INT"), ("D", "A", "U", 1, "Z", "INT"), ("D", "A", "T", 1, "W", "INT")]
    listed = in_listing_order(spark.createDataFrame(rows, "database string, schema string, table string, ordinal int, column_name string, data_type string"))
    assert [r.column_name for r in listed.collect()] == ["W", "Z", "Y", "X"]


def test_counts_end_with_the_total(spark):
    found = [tuple(r) for r in table_counts(spark.createDataFrame(TABLES, TABLES_SCHEMA)).collect()]
    assert found == [("DEV.PUBLIC", 6), ("PROD.ANALYTICS", 2), ("PROD.RAW", 1), ("Total", 9)]


def test_tables_are_worked_out_once(spark):
    tables = spark.range(100).selectExpr("'D' database", "'S' || id % 3 AS schema", "'T' || id AS `table`", "'BASE TABLE' table_type")
    rules = make_rules(spark, [{"database": "d"}, {"database": "d", "schema": "s1"}, {"database": "d", "schema": "s2", "table": "t2"}])
    found = select_tables(rules, tables)
    assert found._jdf.queryExecution().executedPlan().toString().count("Range (0, 100") == 1
    assert {(r.rule_pos, r.rule_idx) for r in found.collect()} == {(0, 0), (0, 1), (0, 2)}


def test_many_rules_meet_many_tables(spark):
    tables = spark.range(50_000).selectExpr(
        "'D' || id % 4 AS database", "'S' || id % 40 AS schema", "'T' || id AS `table`", "'BASE TABLE' AS table_type"
    )
    every = spark.range(16_000).selectExpr(
        "int(id) rule_idx", "'d' || id % 4 AS database", "IF(id % 4 = 0, NULL, 's' || id % 40) AS schema", "IF(id % 2 = 0, NULL, 't' || id) AS table",
        "CAST(NULL AS array<string>) exclude_schema_like", "IF(id % 3 = 0, array('%7'), NULL) exclude_table_like", "false with_views",
    )
    found = select_tables(every, tables)
    # Rules 0 and 12 fix database D0 alone; the first excludes tables that end in 7.
    d0 = found.where("database = 'D0'")
    assert d0.count() == 12_500 and d0.where("`table` LIKE '%7' AND rule_pos = 0").count() == 0
    assert found.where("database = 'D1' AND schema = 'S1' AND `table` = 'T1'").first().rule_pos == 1
