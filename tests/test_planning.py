from __future__ import annotations

import json

import pytest

from conftest import SF_DIR
from tableferry.operators.selection import select_tables
from tableferry.plans.inference import analyze_overrides, available_columns, override_columns, partition_eligible, planned_fields
from tableferry.plans.planning import SETTINGS, RunOptions, build_plan
from tableferry.sources.metadata import parquet_metadata
from tableferry.sources.rules import make_rules
from tableferry.sources.tables import parquet_source

NAMES = ["EVENTS", "ORDERS", "PART"]
PATHS = {("WH", "PUBLIC", n): f"{SF_DIR}/{n.lower()}.parquet" for n in NAMES}
SCHEMA = "database string, schema string, table string, " + ", ".join(f"{k} {v}" for k, v in SETTINGS.items())


@pytest.fixture(scope="module")
def planned(spark):
    """A plan of three tables with settings given by table."""
    found = parquet_metadata(spark, PATHS)
    selected = select_tables(make_rules(spark, [{"database": "WH"}]), found.tables)

    def make(analyzed=True, **given):
        rows = [("WH", "PUBLIC", table, *[values.get(k) for k in SETTINGS]) for table, values in given.items()]
        settings = spark.createDataFrame(rows, SCHEMA)
        outputs = analyze_overrides(settings, parquet_source(spark, PATHS)) if analyzed else None
        return build_plan(selected, found.columns, RunOptions("a", "b", "c"), settings, outputs)

    return make


def by_table(plan, *columns):
    return {r.table: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in plan.collect()}


def user_schema(*fields):
    return json.dumps([dict(zip(("name", "type", "mode"), f)) for f in fields])


def test_each_kind_of_schema(planned):
    plan = planned(
        EVENTS={"override_sql": "SELECT user_id AS `User.Id`, max(ts) AS `last seen` FROM {source} GROUP BY 1", "partition_field": "LAST_SEEN"},
        ORDERS={
            "custom_schema": user_schema(("Day", "date"), ("tags", "string", "repeated"), ("price", "numeric (12, 2)", "REQUIRED")),
            "override_sql": "SELECT 1 AS no_matter FROM {source}",
            "partition_field": "day",
            "partition_unit": "MONTH",
        },
    )
    found = {r.table: (r.schema_origin, [tuple(f) for f in r.target_schema], r.error) for r in plan.collect()}
    assert found["EVENTS"] == ("select", [("user_id", "INTEGER", "NULLABLE"), ("last_seen", "TIMESTAMP", "NULLABLE")], None)
    assert found["ORDERS"] == (
        "schema", [("Day", "DATE", "NULLABLE"), ("tags", "STRING", "REPEATED"), ("price", "NUMERIC(12,2)", "REQUIRED")], None
    )
    assert found["PART"][0] == "inferred" and found["PART"][1][0] == ("p_partkey", "INTEGER", "NULLABLE") and found["PART"][2] is None
    fields = planned_fields(plan)
    assert {tuple(r) for r in partition_eligible(fields).select("table", "display").collect()} == {
        ("EVENTS", "last_seen (TIMESTAMP)"), ("ORDERS", "Day (DATE)")
    }
    assert available_columns(fields.where("table = 'ORDERS'")).orderBy("ordinal").first().display == "Day (DATE)"


def test_a_repeated_date_is_no_partition_field(planned):
    plan = planned(ORDERS={"custom_schema": user_schema(("days", "DATE", "REPEATED")), "partition_field": "days"})
    assert by_table(plan, "error")["ORDERS"] == "Check failed: cannot partition by days: needs a temporal column"
    assert partition_eligible(planned_fields(plan).where("table = 'ORDERS'")).isEmpty()


def test_a_select_that_fails_says_why_in_the_plan(spark, planned):
    given = {"EVENTS": {"override_sql": "SELECT nowhere FROM {source}"}}
    error = by_table(planned(**given), "error")["EVENTS"]
    assert error.startswith("the SELECT cannot be analyzed: ") and "nowhere" in error
    # Without the analysis its schema is not known, and nothing is held against it.
    assert by_table(planned(analyzed=False, **given), "target_schema", "error")["EVENTS"] == (None, None)
    settings = spark.createDataFrame([("WH", "PUBLIC", "EVENTS", "SELECT nowhere FROM {source}")], "database string, schema string, table string, override_sql string")
    assert override_columns(settings, parquet_source(spark, PATHS)).isEmpty()


WRONG = [
    ({"custom_schema": "{"}, "the schema is no list of fields"),
    ({"custom_schema": '{"name": "a", "type": "DATE"}'}, "the schema is no list of fields"),
    ({"custom_schema": '[{"name": "a"}]'}, "a field of the schema lacks 'name' or 'type'"),
    ({"custom_schema": user_schema(("a", "DATUM"))}, "unknown type DATUM of field a"),
    ({"custom_schema": user_schema(("a", "DATE", "MAYBE"))}, "unknown mode MAYBE of field a"),
    ({"custom_schema": user_schema(("a", "DATE"), ("A", "DATE"))}, "schema repeats a field name"),
    ({"custom_schema": '[{"name": "r", "type": "RECORD", "fields": [{"name": "x", "type": "DATE"}]}]'}, None),
    ({"custom_schema": user_schema(("d", "DATE")), "partition_field": "d", "partition_unit": "HOUR"}, "cannot partition the date d by HOUR"),
    ({"partition_field": "n"}, "cannot partition by n: needs a temporal column"),
    ({"partition_field": "nowhere"}, "cannot partition by nowhere: needs a temporal column"),
    ({"partition_field": "DAY", "partition_unit": "MONTH"}, None),
    ({"partition_field": "day", "partition_unit": "WEEK"}, "partition unit must be one of ('HOUR', 'DAY', 'MONTH', 'YEAR')"),
    ({"cluster_fields": ["n", "no", "nope"]}, "cluster fields not in the table: ['no', 'nope']"),
    ({"cluster_fields": ["n", "N"]}, "cluster fields must be at most 4 and distinct"),
    ({"cluster_fields": []}, None),
]


def test_schemas_and_layouts_are_checked_in_the_plan(spark):
    key = [("WH", "PUBLIC", f"T{i}") for i in range(len(WRONG))]
    tables = spark.createDataFrame([(*k, "BASE TABLE", 0) for k in key], "database string, schema string, table string, table_type string, rule_pos int")
    columns = spark.createDataFrame(
        [(*k, i, *c) for k in key for i, c in enumerate([("N", "INT"), ("Day", "DATE")], 1)],
        "database string, schema string, table string, ordinal int, column_name string, data_type string",
    )
    settings = spark.createDataFrame([(*k, *[given.get(name) for name in SETTINGS]) for k, (given, _) in zip(key, WRONG)], SCHEMA)
    found = by_table(build_plan(tables, columns, RunOptions("a", "b", "c"), settings), "error")
    assert found == {k[2]: error and f"Check failed: {error}" for k, (_, error) in zip(key, WRONG)}
