"""The queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import alignment, archives, exact_dedup, fertility, host_reputation, language_model, line_crf, packing, personal_data, pieces, simhash, site_templates, source_audit
from tableferry.llm.common import remainder, table, with_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(with_package(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 7) == 2)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


@query
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


ORACLES["op5_exact_dedup"] = exact_dedup.SQL


@query
def op6_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.round_trip(table(spark, sf_dir, "pages"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 5) == 0
    field = line_crf.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return line_crf.classify(docs, field).withColumn("held_out", held_out)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(table(spark, sf_dir, "pages"))


@query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_templates.main_text(table(spark, sf_dir, "pages"))


@query
def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents"))


ORACLES["op11_personal_data"] = personal_data.SQL


@query
def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


ORACLES["op12_source_audit"] = source_audit.SQL


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))
