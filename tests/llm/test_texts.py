from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.conftest import ODD, prose
from tableferry.llm import fertility, language_model, line_crf, packing, pieces, vocabulary
from tableferry.llm.common import remainder

STRANGE = [
    "a  b", " x", "y ", "", " ", "   ", "a\n b", "a \nb", "foo bar　q ﬁ ①", "x ▁y", "▁", "it's '  don't  ", "a\tb c\n\nd e\r\n f",
    "\U0001f600 z \x1cq \x00", "日本語のテキスト これは", "    def f(x):\n        return x", "http://www.example.com/a?b=1&c=2", "é é ½",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 3.14 --- ===== .....", "<|endoftext|> <s> </s> <0x0A>", "ab" * 5000, prose(5, 300),
]


def ids_of(packed):
    return [np.frombuffer(x, "<u4").tolist() for x in packed]


# --- vocabularies and SentencePiece ----------------------------------------------------------------------------------


def test_byte_vocabulary_agrees_with_the_library():
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    expected = [e.ids for e in model.encode_batch(STRANGE, add_special_tokens=False)]
    for _ in range(2):  # from an empty and from a filled cache
        assert ids_of(vocabulary.byte_bpe().encode(pa.array(STRANGE))) == expected


@pytest.mark.parametrize("make", [vocabulary.piece_bpe, lambda: pieces.opened()[1]])
def test_piece_vocabularies_agree_with_the_library(make):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for _ in range(2):
        assert ids_of(make().encode(pa.array(STRANGE))) == model.encode(STRANGE)


def test_vocabulary_with_a_full_cache(monkeypatch):
    monkeypatch.setattr(vocabulary, "CACHE", 3)
    monkeypatch.setattr(vocabulary, "_ROWS", 2)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert ids_of(vocabulary.piece_bpe().encode(pa.array([*STRANGE, None]))) == [*model.encode(STRANGE), []]


def test_trie_shares_prefixes():
    lattice, _ = pieces.opened()
    words = sorted(["▁the", "▁then", "▁thence", "▁there", "▁a", "▁", "▁\U0001f600the"])
    assert lattice.encode_sorted(words) == [lattice.encode_sorted([w])[0] for w in words]


def test_pieces_over_spark(docs):
    rows = [(i, t) for i, t in enumerate(STRANGE)] + [(100, None)]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    encoded = pieces.encode(docs(rows))
    found = {r.doc_id: r.ids for r in encoded.collect()}
    assert found == {i: model.encode(t or "") for i, t in rows}
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in rows}
    digests = {r.doc_id: r for r in pieces.round_trip(docs(rows)).collect()}
    for i, t in rows:
        packed = np.array(model.encode(t or ""), "<u4").tobytes()
        assert (digests[i].ids_crc32, digests[i].round_trip) == (zlib.crc32(packed), "▁" not in (t or ""))
    assert pieces.round_trip(docs(ODD)).count() == len(ODD) and pieces.round_trip(docs([])).count() == 0


# --- quality rules ---------------------------------------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            duplicates += line in seen
            seen.add(line)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), duplicates, len(repeated)


@pytest.mark.parametrize("text", [t for _, t in ODD] + STRANGE + ["a b c a b c", "a b a b a b", "a\na\n\n\n a", "x # y $$ | <p>\nx\nx"])
def test_base_counts(text):
    assert fertility.counts(text) == base_counts(text)


def test_fertility_over_spark(docs):
    rows = [(i, prose(i, 120)) for i in range(60)] + [(100, prose(1, 120).upper().replace(" ", "!!%% ")), (101, "short"), *ODD]
    found = fertility.judge(docs(rows)).collect()
    assert len(found) == len(rows)
    kept = Counter((r.doc_id, r.kept) for r in found)
    assert all(kept[i, True] for i in range(11, 60)) and kept[100, False] and kept[101, False]
    for r in found:
        assert not (r.base_failed and r.kept)
    out = fertility.keep(docs(rows))
    assert out.columns == docs().columns and out.count() == sum(r.kept for r in found)
    assert fertility.judge(docs([])).count() == 0 and fertility.keep(docs([])).count() == 0


# --- language model --------------------------------------------------------------------------------------------------


def test_base_scores_and_counts(docs):
    rows = ODD + [(i, prose(i)) for i in range(200, 260)]
    found = language_model.score_documents(docs(rows), remainder(F.col("doc_id"), 7) == 2).collect()
    tokens = [[w.lower() for w in (t or "").encode().split()] + [b""] for _, t in rows]
    held = [zlib.crc32((str(i) if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = [
        (i, h, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 4))
        for (i, _), h, ws in zip(rows, held, tokens)
    ]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert all(r.score < 0 for r in found)


def test_scores_without_training_rows(docs):
    found = language_model.score_documents(docs([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in found} == {(1, 0, 0, 0.0), (2, 0, 0, 0.0)}
    assert language_model.score_documents(docs([]), F.lit(False)).count() == 0


def lexicon(settings=language_model.Settings(words=6, word_classes=3, endings=2, hidden=5, window=4, lanes=3, train_lanes=2)):
    words = ["the", "", "of", "and", "to", "in", "rare", "more"]
    return language_model.Lexicon(words, np.array([50, 20, 12, 9, 7, 5, 3, 2]), ["ly", "ed"], np.array([10.0, 8.0, 5.0]), settings), settings


def test_outputs_are_a_distribution():
    lex, settings = lexicon()
    model = language_model.Model(lex, settings, seed=3)
    model.p["class_w"] += np.random.default_rng(1).normal(0, 1, model.p["class_w"].shape).astype(np.float32)
    model.p["word_w"] += np.random.default_rng(2).normal(0, 1, model.p["word_w"].shape).astype(np.float32)
    ids = np.arange(lex.own + len(lex.masses))
    states = np.repeat(np.random.default_rng(4).normal(0, 1, (1, settings.hidden)), len(ids), axis=0).astype(np.float32)
    assert abs(np.exp(language_model.outputs(model, lex, states, ids)[0]).sum() - 1) < 1e-5


def test_windows_and_lanes_do_not_change_a_score():
    lex, settings = lexicon()
    model = language_model.Model(lex, settings, seed=5)
    model.p["class_w"] += np.random.default_rng(1).normal(0, 1, model.p["class_w"].shape).astype(np.float32)
    texts = [np.random.default_rng(i).integers(0, 9, 1 + 7 * i) for i in range(8)]
    together = language_model.score(model, lex, texts, settings)
    alone = [language_model.score(model, lex, [t], language_model.Settings(words=6, word_classes=3, endings=2, hidden=5, window=1000, lanes=1))[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)


def test_gradients_agree_with_differences():
    lex, settings = lexicon()
    model = language_model.Model(lex, settings, seed=7)
    for k in model.p:  # double precision for the differences
        model.p[k] = model.p[k].astype(np.float64) + np.random.default_rng(len(k)).normal(0, 0.3, model.p[k].shape)
    ids = np.random.default_rng(0).integers(0, 9, (4, 2))
    fresh = np.array([[True, False], [False, False], [False, True], [False, False]])
    state = np.random.default_rng(1).normal(0, 0.5, (2, settings.hidden))

    def total():
        before = language_model.forward(model, state, ids, fresh)[0]
        return language_model.outputs(model, lex, before.reshape(-1, settings.hidden), ids.ravel())[0].sum() / ids.size

    trainer = language_model.Trainer(model, lex, settings)
    copy = {k: v.copy() for k, v in model.p.items()}
    squares = {k: v.copy() for k, v in trainer.squares.items()}
    trainer.step(state, ids, fresh, np.ones(ids.shape, bool))
    moved = {k: np.asarray(trainer.squares[k], np.float64) - squares[k] for k in copy}  # squared gradients
    model.p = copy
    for k, at in (("recur", (2, 7)), ("table", (int(ids[0, 0]), 3)), ("class_w", (1, 2)), ("word_b", (4,))):
        copy[k][at] += 1e-3
        high = total()
        copy[k][at] -= 2e-3
        low = total()
        copy[k][at] += 1e-3
        assert abs(abs(high - low) / 2e-3 - math.sqrt(max(0, moved[k][at]))) < 2e-3


def test_training_beats_the_counts():
    words = ["a b c d", "w x y z"]
    settings = language_model.Settings(words=9, word_classes=3, endings=1, hidden=8, window=8, lanes=4, train_lanes=4)
    vocabulary_ = ["", *"abcdwxyz"]
    lex = language_model.Lexicon(vocabulary_, np.array([20] * 9), ["q"], np.array([1.0, 1.0]), settings)
    texts = [np.array([lex.code(w) for w in words[i % 2].split()] * 5 + [lex.code("")]) for i in range(40)]
    model = language_model.Model(lex, settings)
    before = language_model.score(model, lex, texts[:2], settings).sum()
    trainer = language_model.Trainer(model, lex, settings)
    for _ in range(20):
        trainer.fit(texts)
    assert language_model.score(model, lex, texts[:2], settings).sum() > before / 2


# --- classifier ------------------------------------------------------------------------------------------------------


def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(0)
    scores, moves, bounds = rng.normal(0, 1, 9), rng.normal(0, 1, (2, 2)), np.array([0, 4, 4, 5, 9])
    good, _, norm = line_crf.marginals(scores, moves, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        weight = defaultdict(float)
        for code in range(2 ** (b - a)):
            labels = [code >> i & 1 for i in range(b - a)]
            e = sum((1 if y else -1) * s / 2 for y, s in zip(labels, scores[a:b])) + sum(moves[p, q] for p, q in zip(labels, labels[1:]))
            weight[tuple(labels)] = math.exp(e)
        total = sum(weight.values())
        for i in range(b - a):
            assert math.isclose(good[a + i], sum(w for y, w in weight.items() if y[i]) / total)
        if b > a:
            assert math.isclose(norm[a:b].sum(), math.log(total))


def test_classifier_over_spark(docs, spark):
    bad = lambda i: "\n".join(f"$$$ {w.upper()}!!" for w in prose(i, 60).split())
    rows = [(i, prose(i) if i % 3 else bad(i)) for i in range(120)] + [(None, None), (500, ""), (501, " \n "), (502, "x" * 100_000)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)] + [(7, 0), (None, 1)], "doc_id long, quality int")
    learn = remainder(F.col("doc_id"), 5) != 0
    field = line_crf.train(docs(rows), labels, learn)
    found = {r.doc_id: r for r in line_crf.classify(docs(rows), field).collect()}
    assert all(found[i].predicted == int(i % 3 > 0) for i in range(120))
    assert found[500].score == found[501].score == found[None].score and 0 <= found[502].score <= 1
    kept = line_crf.keep(docs(rows), labels, learn)
    assert kept.columns == docs().columns and kept.count() == sum(r.predicted for r in found.values())
    empty = line_crf.train(docs([]), labels, learn)
    assert line_crf.classify(docs([]), empty).count() == 0
    assert [round(r.score, 6) for r in line_crf.classify(docs(ODD), empty).collect()] == [0.5] * len(ODD)


# --- packing ---------------------------------------------------------------------------------------------------------


def test_packing_over_spark(docs):
    rows = [*ODD, *[(i, prose(i, 20 * (i % 40))) for i in range(100, 220)]]
    found = packing.pack(docs(rows), capacity=256).collect()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    want = Counter()
    for i, text in rows:
        ids = [*model.encode(text or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for number, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, number, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want
    places = defaultdict(list)
    for r in found:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 256
    tokens = sum(r.length for r in found)
    assert len(places) <= 1.05 * -(-tokens // 256) + 1
    assert packing.pack(docs([])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4.5, 1, 3000).astype(int), 1, 512) if seed else np.full(50, 400)
    histogram = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    runs = packing.best_plan(histogram, 512)
    used, ranks = defaultdict(list), defaultdict(set)
    for length, rank, number, sequence, offset in runs:
        for k in range(number):
            used[sequence + k].append((offset, length))
            ranks[length].add(rank + k)
    assert {x: len(r) for x, r in ranks.items()} == histogram and all(max(r) == len(r) - 1 for r in ranks.values())
    for spans in used.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and sum(spans[-1]) <= 512
    gaps: list[int] = []
    for length in sorted(lengths.tolist(), reverse=True):  # best fit, one by one
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 512) - length)
    assert len(used) <= 1.01 * len(gaps) + 1
