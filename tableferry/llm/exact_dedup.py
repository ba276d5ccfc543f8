"""Exact duplicates by an extendible-hash index on shared files; DataFrame functions only.

The key of a text is the 64-bit hash of its normalised form. Distinct keys are counted by their leading bits; a bucket
that holds more than ``capacity`` keys is split by one more bit, which doubles the directory, until every bucket fits.
The index (one row for each key: bucket, key, rows) lies in the shared folder; each owner task writes the file of a
range of buckets and keys. Texts are brought together by key and bytes: where keys collide, they form a chain of
different texts, told apart by comparing them. Copies are folded before each shuffle, so that a text with a third of
all rows costs one row for each task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common

#: Distinct keys that a bucket holds before it is split.
CAPACITY = 200_000
#: Leading bits that a directory can use; beyond it a bucket stays overfull (2**40 slots are never reached in practice).
MAX_DEPTH = 40


def normalised(text: Column) -> Column:
    """The text without the white space of the contract; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), common.SPACE, "")


def prefix(key: Column, depth: Column | int) -> Column:
    """The leading ``depth`` bits of a 64-bit key, as a number; the two shifts keep a depth of 0 defined."""
    bits = F.lit(depth) if isinstance(depth, int) else depth
    return F.call_function("shiftrightunsigned", F.shiftrightunsigned(key, 1), (F.lit(63) - bits).cast("int"))


def build_index(keys: DataFrame, capacity: int = CAPACITY, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``key, rows`` (one row for each key) with ``depth, slot``: the bucket that a directory doubling ends with.

    Each round counts the keys of the buckets that are still open by one more bit. The driver sees only how many
    keys are open.
    """
    closed, opened, depth = [], keys.withColumn("depth", F.lit(0)), 0
    open_keys = keys.count()
    while open_keys > capacity and depth < max_depth:
        # As many bits at once as the open keys need on average; the directory doubles that often.
        depth = min(max_depth, depth + max(1, (-(-open_keys // capacity) - 1).bit_length() if depth == 0 else 1))
        slots = opened.groupBy(prefix(F.col("key"), depth).alias("slot")).agg(F.count("*").alias("held"))
        full = common.stored(slots.filter(F.col("held") > capacity).select("slot"), "overfull")
        marked = opened.withColumn("depth", F.lit(depth)).withColumn("slot", prefix(F.col("key"), depth))
        closed.append(marked.join(full, "slot", "left_anti").drop("slot"))
        opened = common.stored(marked.join(full, "slot", "left_semi").drop("slot"), "open")
        open_keys = opened.count()
    for part in closed:
        opened = opened.unionByName(part)
    index = opened.withColumn("slot", prefix(F.col("key"), F.col("depth")))
    # A slot's first key orders the buckets of different depths; every owner gets a range of buckets of the same size.
    first = F.call_function("shiftleft", F.col("slot"), (F.lit(63) - F.col("depth")).cast("int"))
    return index.repartitionByRange(max(1, -(-keys.count() // capacity)), first, "key").sortWithinPartitions("key")


def duplicates(docs: DataFrame, capacity: int = CAPACITY, key_bits: int = 64) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space; null counts as empty, and all empty texts are one group. The
    row with the most code points in its text, then the smallest doc_id, stays; a null doc_id comes after all others.
    Of repeated rows with one doc_id each counts, and all are kept if the id is. An empty table gives no rows. Other
    columns are ignored. ``key_bits``: bits of the key, fewer only to provoke collisions.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), normalised(F.col("text")).alias("norm")
    ).withColumn("key", F.shiftleft(F.shiftrightunsigned(F.xxhash64("norm"), 64 - key_bits), 64 - key_bits))
    entries = common.stored(
        rows.select("doc_id", "key", F.char_length("text").cast("long").alias("chars"), F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256")),
        "entries",
    )
    total = entries.count()
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("least"))).alias("best")
    heads = common.stored(entries.groupBy("key").agg(F.count("*").alias("rows"), best), "heads")
    index = common.stored(build_index(heads, capacity), "index")

    # Texts meet by key and bytes, copies folded to one row in each task; a key with several texts is a collision.
    texts = rows.groupBy("key", "norm").agg(F.count("*").alias("rows"))
    collided = common.stored(texts.groupBy("key").agg(F.count("*").alias("links")).filter("links > 1").select("key"), "collided")

    plain = index.join(collided, "key", "left_anti")
    grouped = plain.filter("rows > 1").select("key", "rows", (-F.col("best.least")).alias("keep_id"), F.col("rows").alias("group_size"))
    alone = plain.filter("rows = 1").select("key")
    single = entries.join(alone, "key", "left_semi").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256"
    )
    out = ["doc_id", "keep_id", "group_size", "text_sha256"]
    result = single.unionByName(common.join_counted(entries, grouped, "key", "rows", total).select(out))
    if not collided.isEmpty():  # different texts with one key form a chain: their bytes tell them apart
        clashed = rows.join(collided, "key", "left_semi")
        order = F.struct(F.char_length("text").alias("chars"), (-F.col("doc_id")).alias("least"))
        chain = clashed.groupBy("key", "norm").agg(F.count("*").alias("group_size"), (-F.max(order)["least"]).alias("keep_id"))
        digest = F.sha2(F.col("norm").cast("binary"), 256)
        found = clashed.select("doc_id", "key", "norm").join(chain, ["key", "norm"]).withColumn("text_sha256", digest)
        result = result.unionByName(found.select(out))
    return result.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``docs`` without the rows that :func:`duplicates` drops; an id that has a row that stays keeps all its rows."""
    judged = common.stored(duplicates(docs, capacity).select("doc_id", "kept"), "judged")
    return common.without(docs, judged.filter("not kept"), judged.filter("kept"))


SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) = 1 AS kept,
       sha256(norm) AS text_sha256
FROM n
"""
