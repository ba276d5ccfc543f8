from __future__ import annotations

import random
import tracemalloc

import duckdb
import pyarrow as pa
import pytest

from llm.conftest import DOCS, sorted_rows
from tableferry.llm import source_audit

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, lang, s, None, "k", 0, "d") for i, (t, lang, s) in enumerate(rows)], DOCS)

    return make


def by_sql(rows, least, top):
    connection = duckdb.connect()
    text, lang, source = zip(*rows) if rows else ((), (), ())
    kind = pa.string()
    connection.register("documents", pa.table({"text": pa.array(text, kind), "lang": pa.array(lang, kind), "source": pa.array(source, kind)}))
    return sorted(connection.execute(source_audit.sql(least, top)).fetchall(), key=repr)


def drawn(seed, n=150):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(80)] + ["Été", "ÉTÉ", "straße", "İx", "日本", "It's", "a1b2", "\U0001f600"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["hot", "hot", "hot", "s1", "s2", None, "S1"])
        rows.append((" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), lang, source))
    return rows + [(None, "xx", "alone"), ("", "yy", "a"), ("123 !?", "yy", "b"), ("one two", "zz", "p"), ("", "zz", "q"), ("one TWO", "zz", "p")]


@pytest.mark.parametrize(("least", "top", "bits"), [(2, 50, 64), (2, 3, 64), (30, 50, 64), (2, 5, 4), (2, 50, 1), (10_000, 50, 64)])
def test_audit_equals_sql(table, least, top, bits):
    rows = drawn(least + top)
    assert sorted_rows(source_audit.audit(table(rows), least, top, bits), *COLUMNS) == by_sql(rows, least, top)


def test_ties_are_ranked_by_bytes(table):
    rows = [(f"{a}{b}", "en", s) for a in "zyxé" for b in "bac" for s in ("one", "one", "two")] + [("other", "en", "two")] * 2
    found = sorted_rows(source_audit.audit(table(rows), 2, 4), *COLUMNS)
    assert found == by_sql(rows, 2, 4)
    assert [r[3] for r in sorted(found, key=lambda r: r[5]) if r[2] == "term" and r[1] == "one"] == ["xa", "xb", "xc", "ya"]


def test_parts_of_the_table_change_nothing(table):
    rows = drawn(9)
    whole = sorted_rows(source_audit.audit(table(rows).coalesce(1), 2), *COLUMNS)
    assert whole == sorted_rows(source_audit.audit(table(rows).repartition(7), 2), *COLUMNS) == by_sql(rows, 2, 50)


def test_slices_of_pairs(table, monkeypatch):
    rows = drawn(4)
    monkeypatch.setattr(source_audit, "PAIR_ROWS", 3)
    assert sorted_rows(source_audit.audit(table(rows), 2), *COLUMNS) == by_sql(rows, 2, 50)


def test_empty_table(table):
    assert source_audit.audit(table([])).collect() == []


def test_only_digests_are_shuffled_for_counts(table):
    plan = source_audit.tally(table(drawn(1)))
    counts = plan.filter("occurs > 0").groupBy("lang", "source", "digest").sum("occurs")
    shuffled = [line for line in counts._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert len(shuffled) == 1 and "term" not in shuffled[0]


def test_a_task_counts_its_texts_together(table):
    rows = [(f"one two {'abc'[i % 3]} One", "en", f"s{i % 2}") for i in range(3000)] + [(None, None, "s1"), (" ", "de", None)]
    found = source_audit.tally(table(rows).coalesce(1)).collect()
    counted = sorted((r.lang, r.source, r.occurs, r.docs) for r in found if r.occurs)
    assert counted == sorted(("en", s, n, d) for s in ("s0", "s1") for n, d in [(3000, 1500), (1500, 1500)] + [(500, 500)] * 3)
    assert sorted(r.term for r in found if r.term is not None) == ["a", "b", "c", "one", "two"]
    assert sorted((r.lang, r.source) for r in found if r.digest is None) == [("", "s1"), ("de", ""), ("en", "s0"), ("en", "s1")]
    assert source_audit.terms_of(pa.array(["", " It's É-é ", "a\x7fB\u00a0c", "", "9"]).slice(1))[0].to_pylist() == ["it", "s", "É", "é", "a", "b\u00a0c"]


def test_texts_counted_in_parts_change_nothing(table):
    rows = drawn(5)
    whole = table(rows)
    held, source_audit.HELD = source_audit.HELD, 100
    try:  # the function that tasks get holds the value
        parts = sorted_rows(source_audit.audit(whole, 2), *COLUMNS)
    finally:
        source_audit.HELD = held
    assert parts == by_sql(rows, 2, 50)


def test_long_text(table):
    rows = [("word " * 200_000 + "tail", "en", "a"), ("word tail", "en", "b"), ("x" * 500_000, "en", "a"), ("x" * 500_000, "en", "b")]
    assert sorted_rows(source_audit.audit(table(rows), 2), *COLUMNS) == by_sql(rows, 2, 50)


class Captured:
    """Stands for a table; gives the function that tasks get."""

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return function


def batch_of(texts):
    langs = pa.array([f"l{i % 7}" for i in range(len(texts))])
    return pa.RecordBatch.from_arrays([langs, pa.array(["s"] * len(texts)), pa.array(texts)], names=["lang", "source", "text"])


def test_parts_of_a_task_are_added_up(table, monkeypatch):
    rows = drawn(6) + [(None, None, "s1"), ("", "", "")]
    plan = table(rows).coalesce(1)
    for split in (False, True):
        whole = source_audit.tally(plan, 64, split).collect()
        with monkeypatch.context() as patch:  # the function that tasks get holds the values
            patch.setattr(source_audit, "CUT", 100)
            patch.setattr(source_audit, "ROWS", 7)
            cut = source_audit.tally(plan, 64, split).collect()
        assert sorted(map(repr, cut)) == sorted(map(repr, whole))  # no count, group or string stands twice
        assert len({(r.lang, r.source, r.digest) for r in cut if r.occurs}) == sum(r.occurs > 0 for r in cut)


def test_a_task_holds_counts_instead_of_terms(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "CUT", 1 << 14)
    batch = batch_of(["some words stand here again and again " * 50] * 2000)
    run = source_audit.tally(Captured())
    list(run(iter([batch.slice(0, 1)])))
    tracemalloc.start()
    try:
        found = list(run(iter([batch])))
        assert sum(x.num_rows for x in found) == 7 + 7 * 6 + 6
        assert tracemalloc.get_traced_memory()[1] < batch.nbytes / 2
    finally:
        tracemalloc.stop()


def test_a_task_puts_out_few_rows_at_once(spark, monkeypatch):
    monkeypatch.setattr(source_audit, "ROWS", 50)
    texts = [" ".join(chr(97 + (i * 7 + j) % 26) * (1 + j % 5) for j in range(300)) for i in range(40)]
    found = list(source_audit.tally(Captured())(iter([batch_of(texts)])))
    assert sum(x.num_rows for x in found) > 900 and max(x.num_rows for x in found) <= 50
