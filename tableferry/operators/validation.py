"""Row counts and their comparison."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.operators.replacement import existing, table_name

SUCCEEDED = "succeeded"
FAILED = "failed"
# Fixed value: the error of unequal counts.
MISMATCH = "Row count mismatch: source=%d, target=%d"


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``table_key, rows`` of every frame, in one job; the scans read no columns."""
    counts = [
        frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(key).alias("table_key"), "rows")
        for key, frame in frames.items()
    ]
    while len(counts) > 1:  # a balanced tree: a chain of unions costs the square of its length
        counts = [reduce(DataFrame.unionAll, counts[i : i + 2]) for i in range(0, len(counts), 2)]
    return counts[0]


def target_row_count(spark: SparkSession, namespace: str, table: str) -> int:
    """Rows of a target table; 0 when it does not exist."""
    if not existing(spark, namespace, table):
        return 0
    return spark.table(table_name(namespace, table)).count()


def mismatch(source: Column, target: Column) -> Column:
    """Error text for unequal counts, else null."""
    before, between, after = (F.lit(x) for x in MISMATCH.split("%d"))
    text = F.concat(before, source.cast("string"), between, target.cast("string"), after)
    return F.when(source != target, text)


def reconcile(source: DataFrame, target: DataFrame, key: str = "table_key") -> DataFrame:
    """Compare expected with loaded row counts per table.

    ``source`` has ``key, rows`` (the rows of the exported selection) and may have
    ``source_rows`` (the whole table); ``target`` has ``key, rows``. A table missing
    on one side counts 0 there.
    """
    extra = [F.col("source_rows")] if "source_rows" in source.columns else []
    left = source.select(key, F.col("rows").alias("expected_rows"), *extra)
    right = target.select(key, F.col("rows").alias("target_rows"))
    filled = left.join(right, key, "full_outer").na.fill(0, ["expected_rows", "target_rows"])
    whole = F.coalesce("source_rows", "expected_rows") if extra else F.col("expected_rows")
    error = mismatch(F.col("expected_rows"), F.col("target_rows"))
    return filled.select(
        key,
        whole.alias("source_rows"),
        "expected_rows",
        "target_rows",
        (F.col("expected_rows") - F.col("target_rows")).alias("difference"),
        F.when(error.isNull(), F.lit(SUCCEEDED)).otherwise(F.lit(FAILED)).alias("status"),
        error.alias("error"),
    )
