from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from llm.conftest import ODD, prose, sorted_rows
from tableferry.llm import common, exact_dedup, simhash


def equal_groups(rows):
    """By brute force: (doc_id, keep_id, group_size, kept, sha) of each row."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((i, len(text or "")))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


@pytest.mark.parametrize("settings", [{}, {"capacity": 2}, {"capacity": 2, "key_bits": 2}, {"key_bits": 1}])
def test_exact_groups(docs, settings):
    rows = [*ODD, (20, prose(2) + "\n"), (21, prose(2).replace(" ", "")), (22, prose(2))]
    assert sorted_rows(exact_dedup.duplicates(docs(rows), **settings), *COLUMNS) == equal_groups(rows)


def test_exact_empty_table(docs):
    assert exact_dedup.duplicates(docs([])).count() == 0
    assert exact_dedup.keep_one(docs([])).count() == 0


def test_exact_keeps_rows_whole(docs):
    kept = exact_dedup.keep_one(docs())
    assert kept.columns == docs().columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {1, 4, 6, 7, 8, 9, 10, None} - {1} | {3}


def test_index_splits_overfull_buckets(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) key", "1L rows")
    index = exact_dedup.build_index(keys, capacity=50)
    assert index.count() == 1000
    assert index.groupBy("depth", "slot").count().agg({"count": "max"}).first()[0] <= 50
    assert index.filter(exact_dedup.prefix(index["key"], index["depth"]) != index["slot"]).count() == 0


def fingerprint(text, width=3):
    words = [w.encode() for w in re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(prints, radius):
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    return {p: root(p) for p in prints}


def test_simhash_components(docs):
    rows = [*ODD, (30, prose(1).upper()), (31, "a b"), (32, "A  b"), *[(40 + i, prose(9, 400) + f" tail{i}") for i in range(12)]]
    prints = [fingerprint(t) for _, t in rows]
    roots = closure(set(prints), simhash.RADIUS)
    least = {}
    for (i, _), p in zip(rows, prints):
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    expected = sorted(((i, f"{p:016x}", least.get(roots[p])) for (i, _), p in zip(rows, prints)), key=repr)
    assert sorted_rows(simhash.near_duplicates(docs(rows)), "doc_id", "fingerprint", "component_id") == expected


def test_simhash_empty_table(docs):
    assert simhash.near_duplicates(docs([])).count() == 0


def test_simhash_keeps_the_smallest(docs):
    kept = simhash.keep_one(docs())
    assert kept.columns == docs().columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 1 in ids and 4 in ids and 5 not in ids and ids.count(None) == 2


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_vantage_point_shards_lose_no_link(monkeypatch, radius):
    monkeypatch.setattr(simhash, "LEAF", 16)
    draw = random.Random(radius)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:  # chains of neighbours
        for _ in range(4):
            p ^= 1 << draw.randrange(64)
            prints.add(p)
    prints |= {draw.getrandbits(6) for _ in range(40)}  # a dense place
    values = np.array(sorted(prints), np.uint64)
    tree = simhash.fit_tree(values[::3], 0.2, radius)
    at, shard = simhash.shards_of(values, tree, radius)
    assert len(set(shard.tolist())) > 2
    found = []
    for s in set(shard.tolist()):
        a, b = simhash.linked(values[at[shard == s]], radius)
        assert (np.bitwise_count(a ^ b) >= 0).all()
        found += list(zip(a.tolist(), b.tolist()))
    parent = {p: p for p in values.tolist()}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in found:
        parent[root(a)] = root(b)
    expected = closure(set(values.tolist()), radius)
    grouped, wanted = defaultdict(set), defaultdict(set)
    for p in values.tolist():
        grouped[root(p)].add(p)
        wanted[expected[p]].add(p)
    assert sorted(map(sorted, grouped.values())) == sorted(map(sorted, wanted.values()))


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (7, 9), (4, 4), (20, 10), (10, 15), (2, 1)] + [(100, i) for i in range(101, 140)]
    found = dict(sorted_rows(common.components(spark.createDataFrame(edges, "a long, b long")), "node", "root"))
    assert found == {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7, 10: 10, 15: 10, 20: 10} | {i: 100 for i in range(100, 140)}
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert {r.root for r in common.components(chain).collect()} == {0}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0
