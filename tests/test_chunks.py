from __future__ import annotations

import threading

import pytest

from tableferry.operators import chunks
from tableferry.operators.chunks import export_chunks, split_files
from tableferry.operators.export import column_mappings
from tableferry.plans import running
from tableferry.plans.planning import RunOptions, build_plan
from tableferry.plans.running import resume, run
from tableferry.operators.selection import select_tables
from tableferry.sources.metadata import parquet_metadata
from tableferry.sources.rules import make_rules
from tableferry.sources.storage import counted_by_footers, scan_files


@pytest.fixture
def source(spark, tmp_path):
    """Six files, in a folder whose name has to be escaped."""
    path = f"{tmp_path}/a source%20folder"
    spark.range(600).selectExpr("id", "'x' || id AS `The Text`").repartition(6, "id").write.parquet(path)
    return spark.read.parquet(path)


class Broken(Exception):
    pass


def break_after(monkeypatch, k):
    real, done = chunks._export_chunk, []

    def export(source, columns, path, cast, chunk):
        if len(done) == k:
            # The chunk's files are written, its record is not.
            real(source, columns, path, cast, chunk)
            raise Broken
        done.append(chunk)
        return real(source, columns, path, cast, chunk)

    monkeypatch.setattr(chunks, "_export_chunk", export)


def test_chunks_hold_whole_files(source):
    files = scan_files(source)
    assert len(files) == 6
    size = files[0][1]
    assert [len(c) for c in split_files(files, 10**9)] == [6]
    assert [len(c) for c in split_files(files, 1)] == [1] * 6
    assert sum(split_files(files, 2 * size + 200), []) == files
    assert split_files([], 5) == []


def test_one_chunk_and_other_frames_are_exported_whole(spark, source, tmp_path):
    assert export_chunks(source, column_mappings(source), f"{tmp_path}/out") is None
    assert export_chunks(source.where("id > 3"), column_mappings(source), f"{tmp_path}/out", chunk_bytes=1) is None
    assert counted_by_footers(source) and not counted_by_footers(source.where("id > 3"))


@pytest.mark.parametrize("k", [0, 1, 5])
def test_a_broken_export_goes_on_behind_its_chunks(spark, source, tmp_path, monkeypatch, k):
    columns, path = column_mappings(source), f"{tmp_path}/out"
    with monkeypatch.context() as patch:
        break_after(patch, k)
        with pytest.raises(Broken):
            export_chunks(source, columns, path, chunk_bytes=1)
    read, real = [], chunks._export_chunk
    monkeypatch.setattr(chunks, "_export_chunk", lambda *a: read.append(a[-1]) or real(*a))
    assert export_chunks(source, columns, path, chunk_bytes=1, resume=True).rows == 600
    assert len(read) == 6 - k
    staged = spark.read.parquet(path)
    assert staged.columns == ["id", "the_text"] and staged.count() == 600 and staged.distinct().count() == 600
    read.clear()
    assert export_chunks(source, columns, path, chunk_bytes=1, resume=True).rows == 600 and read == []
    assert export_chunks(source, columns, path, chunk_bytes=1).rows == 600 and len(read) == 6
    assert spark.read.parquet(path).count() == 600


def test_a_changed_source_or_projection_is_exported_again(spark, source, tmp_path, monkeypatch):
    columns, path = column_mappings(source), f"{tmp_path}/out"
    export_chunks(source, columns, path, chunk_bytes=1)
    read, real = [], chunks._export_chunk
    monkeypatch.setattr(chunks, "_export_chunk", lambda *a: read.append(a[-1]) or real(*a))
    root = f"{tmp_path}/a source%20folder"
    spark.range(600, 650).selectExpr("id", "'x' || id AS `The Text`").coalesce(1).write.mode("append").parquet(root)
    wider = spark.read.parquet(root)
    assert export_chunks(wider, columns, path, chunk_bytes=1, resume=True).rows == 650 and len(read) == 1
    assert export_chunks(wider, columns[:1], path, chunk_bytes=1, resume=True).rows == 650 and len(read) == 8
    assert spark.read.parquet(path).columns == ["id"]


def test_a_chunk_reads_its_own_files_alone(spark, source):
    files = scan_files(source)
    rows = source.where(source.metadataColumn("_metadata")["file_path"].isin([files[0][0]]))
    assert rows.rdd.getNumPartitions() == 1 and 0 < rows.count() < 600


def test_a_source_is_not_overwritten_by_its_chunks(source, tmp_path):
    with pytest.raises(ValueError, match="overwrite its own source"):
        export_chunks(source, column_mappings(source), f"{tmp_path}/a source%20folder", chunk_bytes=1)


KEY = ("WH", "PUBLIC", "T")


@pytest.fixture
def options(tmp_path, namespace):
    return RunOptions(f"{tmp_path}/stage", f"{tmp_path}/target", f"{tmp_path}/manifest", namespace_prefix=f"{namespace}_")


def plan_of(spark, tmp_path, options):
    found = parquet_metadata(spark, {KEY: f"{tmp_path}/a source%20folder"})
    return build_plan(select_tables(make_rules(spark, [{"database": "WH"}]), found.tables), found.columns, options)


def test_a_resumed_run_exports_the_rest_alone(spark, source, tmp_path, options, monkeypatch):
    options = RunOptions(**{**options.__dict__, "chunk_bytes": 1})
    plan = plan_of(spark, tmp_path, options)
    with monkeypatch.context() as patch:
        break_after(patch, 4)
        row = run(spark, plan, lambda *key: source, options, "1").first()
        assert (row.status, row.failed_stage) == ("failed", "Export")
    read, real = [], chunks._export_chunk
    monkeypatch.setattr(chunks, "_export_chunk", lambda *a: read.append(a[-1]) or real(*a))
    row = resume(spark, plan, lambda *key: source, options, "2", "1").first()
    assert (row.status, row.source_rows, row.expected_rows, row.target_rows, len(read)) == ("succeeded", 600, 600, 600, 2)


def test_an_interrupt_after_the_export_leaves_a_load(spark, source, tmp_path, options, monkeypatch):
    plan, real, stopped = plan_of(spark, tmp_path, options), running.export_frame, threading.Event()

    def export(frame, path):
        result = real(frame, path)
        stopped.set()
        return result

    monkeypatch.setattr(running, "export_frame", export)
    row = plan.withColumn("staged_rows", running.F.lit(None).cast("long")).first()
    outcome = running.migrate_table(spark, row, lambda *key: source, options, stopped=_After(stopped))
    assert (outcome["status"], outcome["failed_stage"], outcome["error"]) == ("failed", "Load", "Aborted by user (Ctrl+C)")
    assert (outcome["source_rows"], outcome["expected_rows"]) == (600, 600)


class _After:
    """Set as soon as the export is done, so that the load does not begin."""

    def __init__(self, event):
        self.is_set = event.is_set


def test_a_whole_export_scans_its_source_once(spark, source, tmp_path, options, monkeypatch):
    view = source.where("id >= 0")  # no footers tell its rows
    counted = []
    monkeypatch.setattr(type(view), "count", lambda self: counted.append(1) or 0)
    row = plan_of(spark, tmp_path, options).first()
    monkeypatch.setattr(running, "load_table", lambda *a: None)
    monkeypatch.setattr(running, "target_row_count", lambda *a: 600)
    outcome = running.migrate_table(spark, row, lambda *key: view, options)
    assert (outcome["status"], outcome["source_rows"], counted) == ("succeeded", 600, [])


def test_counting_the_source_of_a_sample_can_be_left_out(spark, source, tmp_path, options):
    sampled = RunOptions(**{**options.__dict__, "sample_rows": 10, "count_sources": False})
    row = plan_of(spark, tmp_path, sampled).first()
    assert running.migrate_table(spark, row, lambda *key: source, sampled)["source_rows"] == 600
    outcome = running.migrate_table(spark, row, lambda *key: source.where("id >= 0"), sampled)
    assert (outcome["status"], outcome.get("source_rows"), outcome["target_rows"]) == ("succeeded", None, 10)
