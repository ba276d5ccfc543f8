from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from tableferry.operators.selection import select_tables
from tableferry.operators.validation import reconcile, row_counts
from tableferry.plans import running
from tableferry.plans.planning import SETTINGS, RunOptions, build_plan, rejected_settings, write_plan
from tableferry.plans.running import dispositions, migrate_table, read_outcomes, remaining, resume, run, status_totals
from tableferry.sources.metadata import COLUMNS_SCHEMA, TABLES_SCHEMA, parquet_metadata
from tableferry.sources.rules import make_rules, rules_from_manifest
from tableferry.sources.tables import parquet_source

from conftest import SF_DIR

NAMES = ["CUSTOMER", "NATION", "ORDERS", "PART", "REGION"]
PATHS = {("WH", "PUBLIC", n): f"{SF_DIR}/{n.lower()}.parquet" for n in NAMES}
ROWS = {"CUSTOMER": 150, "NATION": 25, "ORDERS": 1500, "PART": 200, "REGION": 5}


@pytest.fixture
def options(tmp_path, namespace):
    return RunOptions(f"{tmp_path}/stage/", f"{tmp_path}/target", f"{tmp_path}/manifest", f"{namespace}_")


def plan_for(spark, options, *settings):
    found = parquet_metadata(spark, PATHS)
    kinds = {"database": "string", "schema": "string", "table": "string", **SETTINGS}
    rows = [tuple({"database": "WH", "schema": "PUBLIC", **s}.get(k) for k in kinds) for s in settings]
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in kinds.items())) if rows else None
    selected = select_tables(make_rules(spark, [{"database": "wh"}]), found.tables)
    return build_plan(selected, found.columns, options, frame)


def statuses(outcomes):
    return {r.table: (r.status, r.error) for r in outcomes.collect()}


def test_whole_batch(spark, options):
    outcomes = run(spark, plan_for(spark, options), parquet_source(spark, PATHS), options, "r")
    assert {r.table: (r.status, r.source_rows, r.expected_rows, r.target_rows) for r in outcomes.collect()} == {
        name: ("succeeded", n, n, n) for name, n in ROWS.items()
    }
    assert spark.table(f"{options.namespace_prefix}wh_public.orders").count() == 1500
    assert [tuple(r) for r in status_totals(outcomes).collect()] == [("succeeded", 5)]
    assert read_outcomes(spark, f"{options.manifest_root}/r", "failed").isEmpty()


@pytest.mark.parametrize("max_parallel", [1, 3])
def test_one_failure_does_not_end_the_batch(spark, options, max_parallel):
    options = RunOptions(**{**options.__dict__, "max_parallel": max_parallel})
    paths = {**PATHS, ("WH", "PUBLIC", "CUSTOMER"): "/no/such/path"}
    plan = plan_for(spark, options, {"table": "NATION", "cluster_fields": ["nope"]})
    found = statuses(run(spark, plan, parquet_source(spark, paths), options, "r"))
    assert found["CUSTOMER"][1].startswith("Export failed: ")
    assert found["NATION"] == ("failed", "Check failed: cluster fields not in the table: ['nope']")
    assert {name: found[name][0] for name in ("ORDERS", "PART", "REGION")} == dict.fromkeys(["ORDERS", "PART", "REGION"], "succeeded")


def test_mismatch_is_a_failure(spark, options, monkeypatch):
    monkeypatch.setattr(running, "target_row_count", lambda *_: 99)
    step = plan_for(spark, options).where("table = 'PART'").first()
    outcome = migrate_table(spark, step, parquet_source(spark, PATHS), options)
    assert (outcome["status"], outcome["error"]) == ("failed", "Row count mismatch: source=200, target=99")


def test_sample_compares_with_the_sample(spark, options):
    options = RunOptions(**{**options.__dict__, "sample_rows": 100})
    outcomes = run(spark, plan_for(spark, options), parquet_source(spark, PATHS), options, "r")
    found = {r.table: (r.status, r.source_rows, r.target_rows) for r in outcomes.collect()}
    assert found == {name: ("succeeded", n, min(n, 100)) for name, n in ROWS.items()}


def test_skip_and_abort(spark, options):
    plan = plan_for(spark, options, {"table": "CUSTOMER", "action": "skip"}, {"table": "ORDERS", "action": "abort"})
    read = []

    def source(*key):
        read.append(key[2])
        return parquet_source(spark, PATHS)(*key)

    found = statuses(run(spark, plan, source, options, "r"))
    assert found == {
        "CUSTOMER": ("failed", "Skipped by user"),
        "NATION": ("succeeded", None),
        **dict.fromkeys(["ORDERS", "PART", "REGION"], ("failed", "Aborted by user")),
    }
    assert read == ["NATION"]


def test_interrupt_keeps_finished_outcomes_and_resume_does_the_rest(spark, options):
    plan = plan_for(spark, options)
    reader = parquet_source(spark, PATHS)

    def interrupted(database, schema, table):
        if table == "ORDERS":
            raise KeyboardInterrupt
        return reader(database, schema, table)

    found = statuses(run(spark, plan, interrupted, options, "first"))
    assert found == {
        **dict.fromkeys(["CUSTOMER", "NATION"], ("succeeded", None)),
        **dict.fromkeys(["ORDERS", "PART", "REGION"], ("failed", "Aborted by user (Ctrl+C)")),
    }
    failed = read_outcomes(spark, f"{options.manifest_root}/first", "failed")
    meta = parquet_metadata(spark, PATHS)
    again = select_tables(rules_from_manifest(failed), meta.tables)
    assert sorted(r.table for r in again.collect()) == ["ORDERS", "PART", "REGION"]
    resumed = statuses(resume(spark, plan, reader, options, "second", "first"))
    assert resumed == dict.fromkeys(["ORDERS", "PART", "REGION"], ("succeeded", None))


def test_a_wrong_layout_writes_nothing(spark, options, tmp_path):
    wrong = [{"table": "PART", "cluster_fields": ["nope"]}, {"table": "NATION", "custom_schema": "no json"}, {"table": "ORDERS", "partition_field": "o_custkey"}]
    plan = plan_for(spark, options, *wrong).where("table IN ('PART', 'NATION', 'ORDERS')")
    found = statuses(run(spark, plan, parquet_source(spark, PATHS), options, "r"))
    assert all(status == "failed" and error.startswith("Check failed: ") for status, error in found.values())
    assert not (tmp_path / "stage").exists()


def test_left_out_columns_are_noted(spark, options):
    plan = plan_for(spark, options, {"table": "PART", "custom_schema": '[{"name": "p_partkey", "type": "INTEGER"}]'}).where("table = 'PART'")
    row = run(spark, plan, parquet_source(spark, PATHS), options, "r").first()
    assert row.status == "succeeded" and row.note.startswith("columns that the schema leaves out: p_name, p_brand")


def test_an_unknown_action_and_stray_settings_are_reported(spark, options):
    given = [{"table": "PART", "action": "Abort"}, {"table": "NOWHERE", "action": "skip"}, {"table": "ORDERS", "action": "skip"}]
    errors = {r.table: r.error for r in plan_for(spark, options, *given).collect()}
    assert errors == {**dict.fromkeys(NAMES), "PART": "unknown action Abort"}
    settings = spark.createDataFrame([("WH", "PUBLIC", g["table"], g["action"]) for g in given], "database string, schema string, table string, action string")
    rejected = rejected_settings(settings, plan_for(spark, options))
    assert {r.table: r.reject_reason for r in rejected.collect()} == {"PART": "unknown action Abort", "NOWHERE": "the table is not in the plan"}


def test_no_stage_begins_after_an_interrupt(spark, options, monkeypatch):
    options = RunOptions(**{**options.__dict__, "max_parallel": 2})
    reader, exported = parquet_source(spark, PATHS), threading.Event()
    real = running.export_frame

    def export(frame, path):
        result = real(frame, path)
        if "customer" in path:
            exported.set()
            time.sleep(4)  # between two stages, without a job to cancel
        return result

    def source(database, schema, table):
        if table == "NATION":
            exported.wait(60)
            raise KeyboardInterrupt
        return reader(database, schema, table)

    monkeypatch.setattr(running, "export_frame", export)
    found = statuses(run(spark, plan_for(spark, options), source, options, "r"))
    assert set(found.values()) == {("failed", "Aborted by user (Ctrl+C)")}
    assert not spark.catalog.tableExists(f"{options.namespace_prefix}wh_public.customer")


def test_a_chain_of_runs_moves_each_table_once(spark, options):
    plan, reader, moved = plan_for(spark, options), parquet_source(spark, PATHS), []

    def without(*missing):
        def source(database, schema, table):
            if table in missing:
                raise RuntimeError("away\nfor now")
            moved.append(table)
            return reader(database, schema, table)

        return source

    first = run(spark, plan, without("PART", "ORDERS"), options, "1")
    assert first.where("table = 'PART'").first().error == "Export failed: away\nfor now"
    resume(spark, plan, without("ORDERS"), options, "2", "1")
    resume(spark, plan, without(), options, "3", "2")
    assert sorted(moved) == sorted(NAMES)
    assert running.run_chain(spark, options, "3") == ["3", "2", "1"]


def test_a_failed_load_is_repeated_from_the_staged_files(spark, options, monkeypatch):
    plan, reader = plan_for(spark, options).where("table IN ('PART', 'REGION')"), parquet_source(spark, PATHS)
    real = running.load_table

    def broken(spark, path, root, namespace, table, layout):
        if table == "part":
            raise RuntimeError("no room")
        return real(spark, path, root, namespace, table, layout)

    monkeypatch.setattr(running, "load_table", broken)
    assert statuses(run(spark, plan, reader, options, "1"))["PART"] == ("failed", "Load failed: no room")
    monkeypatch.setattr(running, "load_table", real)

    def gone(*key):
        raise AssertionError("the source is read again")

    row = resume(spark, plan, gone, options, "2", "1", reload=True).collect()
    assert [(r.table, r.status, r.source_rows, r.target_rows) for r in row] == [("PART", "succeeded", 200, 200)]


def test_an_export_alone_is_loaded_by_a_later_run(spark, options):
    plan, reader = plan_for(spark, options, {"table": "PART", "action": "export"}).where("table = 'PART'"), parquet_source(spark, PATHS)
    row = run(spark, plan, reader, options, "1").first()
    assert (row.status, row.error, row.expected_rows, row.failed_stage) == ("failed", "Skipped by user", 200, "Load")
    assert not spark.catalog.tableExists(f"{options.namespace_prefix}wh_public.part")
    again = resume(spark, plan, lambda *key: None, options, "2", "1", reload=True).first()
    assert (again.status, again.target_rows) == ("succeeded", 200)


def test_interrupt_cancels_the_jobs_of_other_tables(spark, options):
    options = RunOptions(**{**options.__dict__, "max_parallel": 2})
    reader = parquet_source(spark, PATHS)

    def slow(frame):
        # Hours of work for no row, unless it is cancelled.
        endless = spark.range(10**13).where("id % 7 > 7")
        return endless.select(*[F.col("id").alias(c) for c in frame.columns])

    def source(database, schema, table):
        if table == "NATION":
            time.sleep(2)
            raise KeyboardInterrupt
        return slow(reader(database, schema, table)) if table == "CUSTOMER" else reader(database, schema, table)

    started = time.monotonic()
    found = statuses(run(spark, plan_for(spark, options), source, options, "r"))
    assert time.monotonic() - started < 45
    assert set(found.values()) == {("failed", "Aborted by user (Ctrl+C)")}


def test_a_run_id_is_used_once(spark, options):
    plan = plan_for(spark, options).where("table = 'REGION'")
    run(spark, plan, parquet_source(spark, PATHS), options, "r")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run(spark, plan, parquet_source(spark, PATHS), options, "r")


def test_time_zone_must_be_the_declared_one(spark, options):
    options = RunOptions(**{**options.__dict__, "session_tz": "Europe/Berlin"})
    with pytest.raises(ValueError, match="time zone"):
        run(spark, plan_for(spark, options), parquet_source(spark, PATHS), options, "r")


def test_first_abort_ends_only_its_run(spark):
    rows = [("a", 1, None), ("a", 2, "abort"), ("a", 3, "skip"), ("a", 4, "abort"), ("b", 1, "skip"), ("b", 2, "proceed")]
    steps = spark.createDataFrame(rows, "run_id string, seq int, action string")
    found = {(r.run_id, r.seq): (r.decision, r.reason) for r in dispositions(steps).collect()}
    assert found == {
        ("a", 1): ("proceed", None),
        ("a", 2): ("failed", "Aborted by user"),
        ("a", 3): ("failed", "Aborted by user"),
        ("a", 4): ("failed", "Aborted by user"),
        ("b", 1): ("failed", "Skipped by user"),
        ("b", 2): ("proceed", None),
    }


# --- plans ----------------------------------------------------------------------------


def small_plan(spark, keys, columns=None, **settings):
    tables = spark.createDataFrame([(*k, "BASE TABLE") for k in keys], TABLES_SCHEMA)
    rows = columns if columns is not None else [(*k, 1, "ID", "NUMBER") for k in keys]
    selected = tables.withColumns({"rule_pos": F.lit(0), "rule_idx": F.lit(0)})
    return build_plan(selected, spark.createDataFrame(rows, COLUMNS_SCHEMA), RunOptions("/s//", "/t", "/m", **settings))


def test_plan_paths_and_sql(spark):
    columns = [
        ("TEST_DB", "PUBLIC", "MY_TABLE", 2, "user.profile.name", "VARCHAR"),
        ("TEST_DB", "PUBLIC", "MY_TABLE", 1, "CREATED_AT", "TIMESTAMP_TZ"),
        ("TEST_DB", "PUBLIC", "MY_TABLE", 3, "a`b", "TIMESTAMP_NTZ"),
    ]
    row = small_plan(spark, [("TEST_DB", "PUBLIC", "MY_TABLE")], columns, sample_rows=100).first()
    assert row.select_sql == (
        "SELECT CAST(`CREATED_AT` AS TIMESTAMP_NTZ) AS `created_at`, `user.profile.name` AS `user_profile_name`, "
        "`a``b` AS `a_b` FROM `TEST_DB`.`PUBLIC`.`MY_TABLE` LIMIT 100"
    )
    assert (row.stage_path, row.stage_location) == ("test_db/public/my_table/", "/s/test_db/public/my_table")
    assert (row.namespace, row.target_table, row.table_key) == ("migrated_test_db_public", "my_table", "TEST_DB.PUBLIC.MY_TABLE")
    assert row.error is None


def test_plan_keeps_tables_it_cannot_plan(spark):
    keys = [("A", "B_C", "T"), ("A_B", "C", "T"), ("D", "P", "Mixed"), ("D", "P", "MIXED"), ("D", "P", "x/y"), ("D", "P", "EMPTY"), ("D", "P", "OK")]
    columns = [(*k, 1, "ID", "NUMBER") for k in keys if k[2] != "EMPTY"]
    errors = {r.table_key: r.error for r in small_plan(spark, keys, columns).collect()}
    assert errors == {
        "A.B_C.T": "another table has the same target",
        "A_B.C.T": "another table has the same target",
        "D.P.Mixed": "another table has the same target",
        "D.P.MIXED": "another table has the same target",
        "D.P.x/y": "a name of the table cannot be used in a path",
        "D.P.EMPTY": "no columns known for the table",
        "D.P.OK": None,
    }


def test_settings_given_twice_are_an_error(spark, options):
    plan = plan_for(spark, options, {"table": "PART", "action": "skip"}, {"table": "PART"}, {"table": "ORDERS"})
    errors = {r.table: r.error for r in plan.collect()}
    assert errors == {**dict.fromkeys(NAMES), "PART": "settings of the table are given more than once"}


def test_roots_are_required():
    with pytest.raises(ValueError, match="target_root is required"):
        RunOptions("/s", "", "/m")


def test_tables_with_plan_errors_touch_nothing(spark, options):
    plan = plan_for(spark, options).withColumn("error", F.when(F.col("table") == "PART", F.lit("bad plan")))
    found = statuses(run(spark, plan, parquet_source(spark, PATHS), options, "r"))
    assert found["PART"] == ("failed", "bad plan")
    assert not spark.catalog.tableExists(f"{options.namespace_prefix}wh_public.part")


def test_dry_run_reads_no_table(spark, options, tmp_path):
    plan = plan_for(spark, options)
    write_plan(plan, f"{tmp_path}/dry")
    assert spark.read.json(f"{tmp_path}/dry").count() == 5
    assert not (tmp_path / "stage").exists() and not (tmp_path / "target").exists()
    assert not any(str(path) in plan._jdf.queryExecution().toString() for path in PATHS.values())


# --- counts ---------------------------------------------------------------------------


def test_reconcile_counts(spark):
    source = spark.createDataFrame([("ok", 100, 5000), ("short", 100, 100), ("gone", 3, 3)], "table_key string, rows long, source_rows long")
    target = spark.createDataFrame([("ok", 100), ("short", 99), ("extra", 2)], "table_key string, rows long")
    found = {r.table_key: (r.source_rows, r.expected_rows, r.target_rows, r.status, r.error) for r in reconcile(source, target).collect()}
    assert found == {
        "ok": (5000, 100, 100, "succeeded", None),
        "short": (100, 100, 99, "failed", "Row count mismatch: source=100, target=99"),
        "gone": (3, 3, 0, "failed", "Row count mismatch: source=3, target=0"),
        "extra": (0, 0, 2, "failed", "Row count mismatch: source=0, target=2"),
    }


def test_counts_read_no_columns_and_no_row_by_row_joins(spark):
    def plan_of(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    counts = plan_of(row_counts({n: spark.read.parquet(f"{SF_DIR}/{n.lower()}.parquet") for n in NAMES}))
    assert counts.count("ReadSchema: struct<>") == len(NAMES)
    tables = spark.createDataFrame([("A", "B", "C", "BASE TABLE")], TABLES_SCHEMA)
    selected = plan_of(select_tables(make_rules(spark, [{"database": "a", "exclude_table_like": ["X%"]}]), tables))
    assert "NestedLoop" not in selected and "Cartesian" not in selected


def test_remaining(spark, options):
    plan = plan_for(spark, options)
    assert sorted(r.table for r in remaining(plan, plan.where("table < 'O'")).collect()) == ["ORDERS", "PART", "REGION"]
