from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.conftest import prose
from tableferry.llm import common, language_model
from tableferry.llm.common import remainder


def test_rounds_train_on_every_training_document_once(docs, monkeypatch):
    kept, store = [], common.stored

    def stored(frame, name, *rest):
        out = store(frame, name, *rest)
        kept.extend([out] if name == "copies" else [])
        return out

    monkeypatch.setattr(common, "stored", stored)
    found = language_model.score_documents(docs([(i, prose(i)) for i in range(90)]), remainder(F.col("doc_id"), 7) == 2).collect()
    trained = sum(r.tokens for frame in kept for r in frame.filter("block = 0").collect())
    assert trained == sum(r.n_tokens for r in found if not r.held_out) == found[0].train_tokens


def test_classes_taken_together_cost_fewer_products_and_change_nothing():
    rng, settings = np.random.default_rng(0), language_model.Settings(words=60, word_classes=20, endings=2, hidden=5)
    words = [f"w{i}" for i in range(70)]
    lexicon = language_model.Lexicon(words, np.sort(rng.integers(1, 400, 70))[::-1], ["w9", "zz"], np.array([9.0, 8.0, 5.0]), settings)
    assert len(lexicon.together) < len(lexicon.alone) / 2
    model = language_model.Model(lexicon, settings, seed=3)
    for k in ("class_w", "word_w"):
        model.p[k] += rng.normal(0, 1, model.p[k].shape).astype(np.float32)
    ids, states = rng.integers(0, 63, 3000), rng.normal(0, 0.5, (3000, 5)).astype(np.float32)
    found = []
    for groups in (lexicon.together, lexicon.alone):
        lexicon.together = groups
        grads = {k: np.zeros_like(v) for k, v in model.p.items()}
        logs, back = language_model.outputs(model, lexicon, states, ids, grads)
        found.append([logs, back, grads["word_w"], grads["word_b"], grads["class_w"]])
    assert all(np.allclose(a, b, atol=2e-3) for a, b in zip(*found))
    assert np.allclose(found[0][0], language_model.outputs(model, lexicon, states, ids)[0], atol=1e-4)


def test_words_of_a_batch_are_coded_at_once():
    settings = language_model.Settings(words=3, word_classes=2, endings=2)
    lexicon = language_model.Lexicon(["the", "", "é"], np.array([9, 5, 4]), ["ly", "é"], np.array([3.0, 2.0, 1.0]), settings)
    texts = pa.array(["The badly é zé\tly y", None, "", "aé \U0001f600\U0001f600 the"])
    coded = language_model.Coded(texts, lexicon)
    assert [lexicon.code(w) for w in coded.dictionary.to_pylist()] == coded.codes.tolist()
    assert [t.tolist() for t in coded.texts][1:3] == [[lexicon.code("")]] * 2
    nothing = language_model.Lexicon([], np.zeros(0, np.int64), [], np.array([1.0]), settings)
    assert [t.tolist() for t in language_model.Coded(pa.array(["a b"]), nothing).texts] == [[0, 0, 0]]


def test_training_codes_texts_as_scoring_does():
    settings = language_model.Settings(words=3, word_classes=2, endings=2)
    lexicon = language_model.Lexicon(["the", "", "é"], np.array([9, 5, 4]), ["ly", "é"], np.array([3.0, 2.0, 1.0]), settings)
    nothing = language_model.Lexicon([], np.zeros(0, np.int64), [], np.array([1.0]), settings)
    for texts in (["The badly é zé\tly y", None, "", "aé \U0001f600\U0001f600 the"], [None], ["the the"], []):
        for lex in (lexicon, nothing):
            column = pa.array(texts, pa.string())
            found, coded = language_model.coded_texts(column, lex), language_model.Coded(column, lex)
            assert [x.tolist() for x in found] == [x.tolist() for x in coded.texts]
            assert [x[:-1].tolist() for x in found] == [[lex.code(w.decode()) for w in common.words_of(t)] for t in texts]


def test_words_held_by_tasks_are_not_joined(docs, monkeypatch):
    kept, store = [], common.stored

    def stored(frame, name, *rest):
        out = store(frame, name, *rest)
        kept.extend([out] if name == "scored" else [])
        return out

    monkeypatch.setattr(common, "stored", stored)
    monkeypatch.setattr(language_model, "COMMON", 0.02)
    table, found, listed = docs([(i, prose(i)) for i in range(60)]), [], []
    for held in (10_000, 30, 1):
        monkeypatch.setattr(language_model, "HELD", held)
        rows = language_model.score_documents(table, remainder(F.col("doc_id"), 7) == 2).orderBy("doc_id").collect()
        found.append([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows])
        listed.append({r.word for r in kept[-1].selectExpr("explode(rare.word) AS word").collect()})
    assert found[0] == found[1] == found[2]
    assert listed[0] < listed[1] < listed[2]
    counted = {r.word: r.n for r in language_model.word_counts(table.filter(remainder(F.col("doc_id"), 7) != 2)).collect()}
    assert not listed[0] & set(counted)  # only words that training never met


def test_least_count_that_is_held(spark, monkeypatch):
    counts = spark.createDataFrame([(f"w{i}", n) for i, n in enumerate([900, 40, 30, 9, 9, 9, 2, 1, 1])], "word string, n long")
    monkeypatch.setattr(language_model, "COMMON", 0.025)  # a little over 25 of 1001
    for held, least in [(2, 0.025 * 1001), (3, 0.025 * 1001), (5, 0.025 * 1001), (6, 9), (7, 2), (8, 2), (9, 1), (99, 1)]:
        monkeypatch.setattr(language_model, "HELD", held)
        assert language_model.least_held(counts, 1001) == least
    assert language_model.least_held(counts.limit(0), 0) == 0


def test_rows_of_each_input_are_summed_in_layers():
    rng = np.random.default_rng(1)
    keys = np.sort(np.concatenate([[0] * 40, [7] * 6, [8] * 7, rng.integers(0, 30, 50), [99]]).astype(np.uint16))
    rows, order = rng.normal(0, 1, (200, 6)).astype(np.float32), rng.permutation(200)[: len(keys)]
    found, sums = language_model.summed(rows, order, keys)
    assert sorted(found.tolist()) == sorted(set(keys.tolist()))
    assert all(np.allclose(s, rows[order[keys == k]].sum(axis=0), atol=1e-4) for k, s in zip(found, sums))


def test_training_leaves_logarithms_out_and_scoring_keeps_one_step(monkeypatch):
    rng, settings = np.random.default_rng(2), language_model.Settings(words=40, word_classes=8, endings=2, hidden=6, window=8, lanes=4, train_lanes=4)
    lexicon = language_model.Lexicon([f"w{i}" for i in range(40)], np.arange(90, 50, -1), ["w9", "zz"], np.array([9.0, 8.0, 5.0]), settings)
    model = language_model.Model(lexicon, settings, seed=4)
    ids, states = rng.integers(0, 43, 500), rng.normal(0, 0.5, (500, 6)).astype(np.float32)
    found = []
    for rows, wanted in ((500, True), (64, False)):
        monkeypatch.setattr(language_model, "ROWS", rows)
        grads = {k: np.zeros_like(v) for k, v in model.p.items()}
        logs, back = language_model.outputs(model, lexicon, states, ids, grads, wanted)
        found.append([back, grads["word_w"], grads["class_w"], grads["class_b"]])
        assert (logs is not None) == wanted
    assert all(np.allclose(a, b, atol=2e-3) for a, b in zip(*found))
    window, fresh = ids[:32].reshape(8, 4), rng.random((8, 4)) < 0.2
    start, trace = rng.normal(0, 0.5, (4, 6)).astype(np.float32), []
    plain, traced = language_model.forward(model, start, window, fresh), language_model.forward(model, start, window, fresh, trace)
    assert all(np.array_equal(a, b) for a, b in zip(plain, traced))
    assert len({x.__array_interface__["data"][0] for x in trace}) == 5 and len(trace[0]) == len(trace[3]) == 8
