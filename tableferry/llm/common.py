"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableferry.sources.storage import scratch_directory

#: Fixed value: the white space of the query contracts.
SPACE = "\x20\t\n\x0b\x0c\r"

#: A key with at least this share of all rows is hot. There are at most ``1 / HOT_SHARE`` such keys, so they
#: can be broadcast at any size of the input.
HOT_SHARE = 1e-3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers on this host import the package. On a cluster it is installed or sent with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")
    return spark


def stored(frame: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """The frame, written once to the shared scratch folder: later steps read files and survive lost executors."""
    spark = frame.sparkSession
    path = f"{scratch_directory(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    (frame.coalesce(partitions) if partitions else frame).write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of a key as text, modulo; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a text as UTF-8; bytes split at exactly the white space of ``SPACE``."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def by_batch(function: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable:
    """For ``mapInArrow``: one batch in, one out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return run


def bounded_sample(frame: DataFrame, key: str, size: int) -> DataFrame:
    """About ``size`` rows, and at most twice as many, chosen by the hash of ``key``; all rows if there are no more.

    A filter, so that what reaches the last task does not grow with the number of tasks, as with an ordered limit.
    """
    steps = 1 << 30
    share = min(steps, -(-size * steps // max(1, frame.count())))
    return frame.filter(F.pmod(F.xxhash64(key), F.lit(steps)) < share).limit(2 * size)


def join_counted(left: DataFrame, right: DataFrame, key: str, rows: str, total: int) -> DataFrame:
    """Inner join on ``key`` where ``right`` has one row for each key and counts its rows on the left in ``rows``.

    Hot keys, at most ``1 / HOT_SHARE`` of them, are broadcast, so that no task gets all rows of one key; the rest
    is joined by shuffle. ``left`` is read twice and should be stored.
    """
    hot = right.filter(F.col(rows) >= HOT_SHARE * total)
    cold = right.filter(F.col(rows) < HOT_SHARE * total)
    at_hot = left.join(F.broadcast(hot), key)
    others = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return at_hot.unionByName(others)


def without(docs: DataFrame, dropped: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is in ``dropped`` and not in ``kept`` leave; rows without an id stay.

    Ids alone decide, so the join's hash table holds ids. It is always a shuffle: a broadcast of ids would have to stop
    at some size of the input.
    """
    gone = dropped.select("doc_id").distinct().join(kept.select("doc_id"), "doc_id", "left_anti")
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b of one orderable type): one row ``node, root`` for each node that has
    an edge to another; ``root`` is the smallest node of its component.

    Alternates large-star and small-star steps until nothing changes. Each round is written to the shared folder.
    Stars are taken from a minimum that is aggregated before the shuffle; a hub's edges meet it in a join that
    Spark may split.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        size = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if before == size or not size["n"]:
            break
        before = size
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("y")).union(low.select("a", "m"))
        edges = stored(small.filter("x <> y").toDF("a", "b").distinct(), "small")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
