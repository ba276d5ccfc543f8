"""A cleaning pipeline over ``documents``: each stage reads what its predecessor kept, as Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.llm import exact_dedup, fertility, line_crf, packing, simhash
from tableferry.llm.common import remainder, table, with_package
from tableferry.sources.storage import scratch_directory


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the bands of tokeniser fertility of their language."""
    with_package(spark)
    return fertility.keep(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines are predicted good; the field learns from labelled rows outside the held-out fifth."""
    with_package(spark)
    return line_crf.keep(docs, table(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 5) != 0)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    with_package(spark)
    return exact_dedup.keep_one(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints over three-word shingles that differ in at most two bits."""
    with_package(spark)
    return simhash.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, packed into sequences."""
    with_package(spark)
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_duplicates),
    ("near-dedup", near_duplicates),
    ("best-fit packing", best_fit_packing),
]

#: The fitted classifier, the fingerprints and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A table without rows passes through every stage."""
    docs, root = table(spark, sf_dir, "documents"), f"{scratch_directory(spark)}/pipeline-{uuid.uuid4().hex[:8]}"
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{number}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{number}")
    return docs
