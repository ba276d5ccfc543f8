"""Near duplicates by SimHash: fingerprints linked within a Hamming radius through vantage-point trees.

A shard tree of vantage points is fitted on a bounded sample of distinct fingerprints. At a node with vantage point
``p`` and radius ``mu`` a fingerprint at distance ``d`` goes left if ``d <= mu + r`` and right if ``d > mu``: by the
triangle inequality two fingerprints within ``r`` of each other always meet in one child, so the shards that overlap
at the boundary hold every pair, whatever the sample was. Each shard builds its own vantage-point tree in the same
way and compares all pairs in its leaves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common

SEED = 42
WIDTH = 3
RADIUS = 2
#: Fingerprints that a shard should hold, and those that a leaf of its tree compares with each other.
SHARD = 20_000
LEAF = 512
#: Rows of the sample from which the shard tree is fitted; the result does not depend on it.
SAMPLE = 100_000


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """SimHash of the word shingles of a whole text; 0 for a text without words."""
    words = common.words_of(text)
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return digest(b" ".join(words), SEED)
    joined, ends, at = b" ".join(words), [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0] + [end + 1 for end in ends[:-1]]
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])), np.uint64)
    votes = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[part : part + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id and ``print`` (the 64 bits as a long) of each row; a null text counts as empty."""

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = _signed([fingerprint(x, width) for x in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), prints], names=["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(common.by_batch(of), "doc_id long, print long")


# --- vantage-point trees -------------------------------------------------------------------------------------------


def _distances(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point)


def _split(prints: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int] | None:
    """Vantage point and radius whose larger child is smallest; None where no split helps."""
    best, found = len(prints) * 0.95, None
    for point in rng.choice(prints, min(8, len(prints)), replace=False):
        counts = np.bincount(_distances(prints, point), minlength=65)
        within = np.cumsum(counts)
        left = np.minimum(within[np.minimum(np.arange(65) + radius, 64)], len(prints))
        larger = np.maximum(left, len(prints) - within)
        mu = int(np.argmin(larger))
        if larger[mu] < best:
            best, found = larger[mu], (point, mu)
    return found


def fit_tree(sample: np.ndarray, share: float, radius: int, seed: int = 0):
    """Nested tuples ``(point, mu, left, right)``; an integer is a shard. ``share``: of the sample that a shard may hold."""
    rng, shards = np.random.default_rng(seed), iter(range(1 << 30))
    limit = max(64.0, share * len(sample))

    def grow(prints: np.ndarray):
        split = _split(prints, radius, rng) if len(prints) > limit else None
        if split is None:
            return next(shards)
        d = _distances(prints, split[0])
        return (*split, grow(prints[d <= split[1] + radius]), grow(prints[d > split[1]]))

    return grow(sample)


def shards_of(prints: np.ndarray, tree, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and shards; a print near boundaries is in several."""
    at, shard, todo = [], [], [(np.arange(len(prints)), tree)]
    while todo:
        rows, node = todo.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            at.append(rows)
            shard.append(np.full(len(rows), node, np.int32))
            continue
        point, mu, left, right = node
        d = _distances(prints[rows], point)
        todo += [(rows[d <= mu + radius], left), (rows[d > mu], right)]
    return np.concatenate(at), np.concatenate(shard)


def linked(prints: np.ndarray, radius: int = RADIUS, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius among distinct prints of one shard, thinned to a spanning star of each local component."""
    rng, parent = np.random.default_rng(seed), np.arange(len(prints))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    todo = [np.arange(len(prints))]
    while todo:
        rows = todo.pop()
        split = _split(prints[rows], radius, rng) if len(rows) > LEAF else None
        if split is not None:
            d = _distances(prints[rows], split[0])
            todo += [rows[d <= split[1] + radius], rows[d > split[1]]]
            continue
        for part in range(0, len(rows), LEAF):  # a leaf that no vantage point divides is compared in blocks
            block = prints[rows[part : part + LEAF], None]
            near = np.argwhere(np.bitwise_count(block ^ prints[None, rows]) <= radius)
            for i, j in near[near[:, 0] + part < near[:, 1]]:
                a, b = root(rows[i + part]), root(rows[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
    roots = np.array([root(i) for i in range(len(prints))], np.int64)
    own = np.flatnonzero(roots != np.arange(len(prints)))
    return prints[own], prints[roots[own]]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a, b`` between distinct prints that connect all that are within the radius of each other."""
    total = prints.count()
    rows = np.sort(common.bounded_sample(prints, "print", SAMPLE).toArrow().column("print").to_numpy())
    tree = fit_tree(rows.view(np.uint64), SHARD / max(total, 1), radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at, shard = shards_of(batch.column(0).to_numpy().view(np.uint64), tree, radius)
                yield pa.RecordBatch.from_arrays([pa.array(shard), batch.column(0).take(pa.array(at))], names=["shard", "print"])

    def meet(group: pa.Table) -> pa.Table:
        a, b = linked(np.sort(group.column("print").to_numpy().view(np.uint64)), radius)
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = prints.select("print").mapInArrow(deal, "shard int, print long")
    return dealt.groupBy("shard").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows and ids stay as rows of
    one component. A null doc_id is never a component's id unless its component has no other. An empty table gives
    no rows. Other columns are ignored.

    Rows of one fingerprint become one node before anything is compared, so a group of copies costs one comparison.
    """
    rows = common.stored(fingerprints(docs, width), "fingerprints")
    nodes = common.stored(rows.groupBy("print").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first")), "nodes")
    total = rows.count()
    roots = common.stored(common.components(links(nodes.select("print"), radius)), "roots")
    placed = nodes.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("root", "print"))
    placed = common.stored(placed, "placed")
    ids = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    return common.join_counted(rows, placed.join(ids, "root").select("print", "rows", "component_id"), "print", "rows", total).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``docs`` with the smallest doc_id of each component alone; rows that repeat it stay, as do rows without an id."""
    placed = common.stored(near_duplicates(docs, width, radius).select("doc_id", "component_id"), "placed")
    return common.without(docs, placed.filter("doc_id <> component_id"), placed.filter("doc_id = component_id"))
