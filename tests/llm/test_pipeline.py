from __future__ import annotations

import importlib
import sys

import oracle
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from conftest import SF_DIR
from llm.conftest import ODD, prose
from tableferry.llm import common, exact_dedup, queries


def test_stages_follow_one_another(spark):
    docs = common.table(spark, SF_DIR, "documents")
    before, counts = docs, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = common.stored(stage(spark, before, SF_DIR), "stage")
        assert out.schema == docs.schema
        assert out.join(before, docs.columns, "left_anti").count() == 0  # rows come whole from the stage before
        counts.append(out.count())
        before = out
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SF_DIR)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    groups = exact_dedup.duplicates(before)
    assert groups.filter("group_size > 1").count() == 0


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF_DIR).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_source_audit"}))  # has rows for groups, not documents
def test_queries_cover_their_table(spark, name):
    table = "pages" if name.startswith(("op6", "op9", "op10")) else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    found = queries.QUERIES[name](spark, SF_DIR)
    ids = {r[0] for r in common.table(spark, SF_DIR, table).select(key).collect()}
    assert {r[0] for r in found.select(key).collect()} == ids


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_agree_with_sql(spark, name):
    assert oracle.spark_rows(queries.QUERIES[name](spark, SF_DIR)) == oracle.oracle_rows(oracle.connect(SF_DIR), queries.ORACLES[name])


def test_entry_has_every_query():
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in contract.queries() if k.startswith("op")}
    assert "pipeline" in contract.queries()


def test_entry_without_the_subpackage(monkeypatch):
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if "llm" in name or name == "corpus_pipeline" else find(name, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    again = importlib.import_module("__spark_entry__")
    assert again.queries() and not any(k.startswith("op") or k == "pipeline" for k in again.queries())


def pipeline_over(spark, tmp_path, frame, labels):
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return corpus_pipeline.run(spark, str(tmp_path))


def test_pipeline_over_an_empty_table(spark, docs, tmp_path):
    assert pipeline_over(spark, tmp_path, docs([]), []).count() == 0


def test_pipeline_over_odd_rows(spark, docs, tmp_path):
    """Nulls, empty and long texts, repeated rows and ids, columns with names that stages use; copies leave, the others stay."""
    rows = [*ODD, *[(100 + i, prose(100 + i)) for i in range(60)], (300, prose(100) + " \n"), (301, prose(101))]
    labels = [(100 + i, 1, 0) for i in range(60)] + [(2, 0, 0), (3, 0, 0), (10, 0, 0)]
    found = pipeline_over(spark, tmp_path, docs(rows), labels)
    kept = {r.doc_id for r in found.collect()}
    assert kept <= {i for i, _ in rows} and len(kept & set(range(100, 160))) > 30
    assert 2 not in kept and 10 not in kept  # too few words
    assert not {100, 300} <= kept and not {101, 301} <= kept
