"""Scoring texts by a gated recurrent language model with a class-factored output.

Counts of all training words come first. The most frequent words are the model's own; they are cut into classes of equal
mass. All other words belong to classes by their last two characters. The probability of a word is that of its class,
given the recurrent state, times that of the word within its class: a softmax of the state for the model's own words,
and the smoothed count for the others. Each class of other words keeps one unit of mass for a word never seen. At the
start of training the output biases are the counts, so that the untrained model is the smoothed unigram model.

The recurrent unit is trained in numpy by backpropagation truncated to windows, with the state carried from one window
to the next: the rounds divide all training documents, copies of the model train on parts of a round, and are averaged. A text is scored as a whole, with its state carried to its end. Texts run side by side in lanes.

Words with at least ``COMMON`` of all training tokens, at most ``1 / COMMON`` of them, are broadcast with their counts, and
the next most frequent ones as long as no more than ``HELD`` are; the counts of all others are joined by word.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common

COMMON, HELD = 1e-6, 200_000
#: The end of a text, which no word equals.
END = ""
#: Sum of squares that each parameter's step size starts from.
START = 1e-5
#: Training takes neighbouring classes together up to so many words; scoring puts out so many tokens at once; as many
#: tokens as stay in a core's cache are taken over all classes at once.
TOGETHER, CHUNK, ROWS = 48, 16_384, 384
#: So many rows of each input are summed at once with those of the others.
LAYERS = 6


@dataclass(frozen=True)
class Settings:
    words: int = 1024  #: the model's own words
    word_classes: int = 32
    endings: int = 63  #: classes of other words: this many frequent endings, and the rest
    hidden: int = 24
    window: int = 32  #: tokens after which backpropagation is cut
    lanes: int = 128  #: side by side in scoring; scores do not depend on it
    train_lanes: int = 64
    rounds: int = 3  #: each trains on its part of the training documents; together they use every document once
    rate: float = 0.1
    task: int = 4_000_000  #: training tokens of a copy, by which the copies of a round are counted
    group: int = 5 << 20  #: bytes of text that run side by side


# --- counts --------------------------------------------------------------------------------------------------------


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of a batch, lower-cased (A-Z), and where each text's words begin and end among them."""
    low = pc.ascii_lower(texts.fill_null(""))  # its offsets start at 0, as a cast needs
    lists = pc.ascii_split_whitespace(low.cast(pa.large_string()))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy()
    full = pc.not_equal(flat, "")  # white space at an end leaves an empty word
    if not pc.all(full, min_count=0).as_py():
        offsets = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))[offsets]
        flat = flat.filter(full)
    return flat, offsets


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts; the empty word counts their ends. Counted by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = split_words(batch.column(0))[0].value_counts()
                words, n = found.field("values").cast(pa.string()), found.field("counts").cast(pa.int64())
                yield pa.RecordBatch.from_arrays([words, n], names=["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([END]), pa.array([batch.num_rows], pa.int64())], names=["word", "n"])

    return docs.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_held(counts: DataFrame, total: int) -> float:
    """From which count on words are broadcast: ``COMMON`` of all, or less where no more than ``HELD`` words reach it."""
    least = COMMON * total
    sizes = counts.groupBy(F.least("n", F.lit(math.ceil(least))).alias("n")).agg(F.count("*").alias("words"))
    held = 0
    for row in sorted(sizes.collect(), reverse=True):  # a row for each count up to COMMON of all
        held += row["words"]
        if held > HELD:
            break
        least = min(least, row["n"])
    return least


# --- the model -----------------------------------------------------------------------------------------------------


class Lexicon:
    """Numbers of words: the model's own from 0 on, then the classes of other words."""

    def __init__(self, common_words: list[str], counts: np.ndarray, endings: list[str], masses: np.ndarray, settings: Settings):
        own = min(settings.words, len(common_words))
        self.common, self.common_counts = pa.array(common_words, pa.large_string()), np.asarray(counts, np.int64)
        self.number = {w: i for i, w in enumerate(common_words[:own])}
        self.own, self.own_counts = own, counts[:own].astype(np.float64) + 1
        self.ending = {e: i for i, e in enumerate(endings)}
        self.masses = masses  # of the classes of other words, with one unit for words never seen
        total = np.cumsum(self.own_counts)
        cut = np.searchsorted(total, total[-1] * np.arange(1, settings.word_classes) / settings.word_classes) + 1 if own else []
        self.bounds = np.unique(np.concatenate([[0], np.minimum(cut, own), [own]]).astype(np.int64))
        self.classes = len(self.bounds) - 1
        self.class_of = np.concatenate([np.repeat(np.arange(self.classes), np.diff(self.bounds)), self.classes + np.arange(len(masses))])
        self.class_of = self.class_of.astype(np.uint16)  # short numbers are sorted by their digits
        self.words_, self.endings_ = pa.array(common_words[:own], pa.large_string()), pa.array(endings, pa.large_string())
        self.alone, self.together = self._groups(0), self._groups(TOGETHER)

    def _groups(self, most: int) -> list[tuple[int, int, np.ndarray | None]]:
        """First and last class (exclusive) of groups of at most ``most`` words, or of one class; without classes of one word.

        Of more classes than one also what is added to the words of each class: nothing to its own, minus infinity to others.
        """
        groups: list[list[int]] = []
        for c in range(self.classes):
            if self.bounds[c + 1] - self.bounds[c] == 1:
                continue
            if groups and groups[-1][1] == c and self.bounds[c + 1] - self.bounds[groups[-1][0]] <= most:
                groups[-1][1] = c + 1
            else:
                groups.append([c, c + 1])
        found = []
        for first, last in groups:
            own = np.arange(first, last)[:, None] == np.repeat(np.arange(first, last), np.diff(self.bounds[first : last + 1]))
            found.append((first, last, np.where(own, 0, -np.inf).astype(np.float32) if last - first > 1 else None))
        return found

    def code(self, word: str) -> int:
        found = self.number.get(word)
        return self.own + self.ending.get(word[-2:], len(self.ending)) if found is None else found

    def counts(self, words: pa.Array) -> np.ndarray:
        """How often each word occurs in training; -1 if it is not among those broadcast."""
        at = pc.fill_null(pc.index_in(words, value_set=self.common), -1).to_numpy()
        return np.append(self.common_counts, -1)[at]

    def codes(self, words: pa.Array) -> np.ndarray:
        number = pc.index_in(words, value_set=self.words_)
        found = pc.fill_null(number, -1).to_numpy(zero_copy_only=False).astype(np.int32)
        ending = pc.index_in(pc.utf8_slice_codeunits(words.filter(pc.is_null(number)), -2), value_set=self.endings_)
        found[found < 0] = pc.fill_null(ending, len(self.ending)).to_numpy(zero_copy_only=False) + self.own
        return found


class Model:
    """Parameters by name; ``table`` holds each input's contribution to the three gates."""

    def __init__(self, lexicon: Lexicon, settings: Settings, seed: int = 0):
        rng, h = np.random.default_rng(seed), settings.hidden
        inputs, outputs = lexicon.own + len(lexicon.masses), lexicon.classes + len(lexicon.masses)
        mass = np.concatenate([np.add.reduceat(lexicon.own_counts, lexicon.bounds[:-1]) if lexicon.own else [], lexicon.masses])
        normal = lambda *shape: rng.normal(0, 0.1, shape)
        values = {
            "table": normal(inputs, 3 * h),
            "recur": normal(h, 3 * h),
            "class_w": np.zeros((h, outputs)),
            "class_b": np.log(mass / mass.sum()),
            "word_w": np.zeros((lexicon.own, h)),
            "word_b": np.log(lexicon.own_counts),
        }
        self.p = {k: np.asarray(v, np.float32) for k, v in values.items()}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, flat: np.ndarray) -> Model:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self


def halved(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The weights of the gates as :func:`forward` takes them.

    A sigmoid is half of one and the hyperbolic tangent of half its argument: the half is taken once, in the weights. The
    recurrent part of the candidate is halved as well, as it is multiplied by twice the sigmoid.
    """
    h = len(model.p["recur"])
    half = np.repeat(np.array([0.5, 1], np.float32), [2 * h, h])
    return model.p["table"] * half, np.ascontiguousarray((model.p["recur"] * np.float32(0.5)).T)


def forward(
    model: Model, state: np.ndarray, ids: np.ndarray, fresh: np.ndarray, trace: list | None = None, weights: tuple | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """States before each token of a window, and the state after it. ``ids`` and ``fresh`` (a text begins) are time x lanes.

    Gates lie one behind another (gate x hidden x lanes), so that each step works on whole stretches of memory. With
    ``trace`` what the steps had is added to it: states, the first sigmoid, twice the second, the candidate, and half its recurrent part.
    """
    steps, (lanes, h) = len(ids), state.shape
    table, recur = weights or halved(model)
    gates = table.take(ids, axis=0).transpose(0, 2, 1)
    states = np.empty((steps + 1, h, lanes), np.float32)
    # Without a trace the gates of one step take the place of those before them, which are still in the core's cache.
    kept_steps = steps if trace is not None else 1
    owns, candidates = np.empty((kept_steps, 3 * h, lanes), np.float32), np.empty((kept_steps, h, lanes), np.float32)
    states[0] = state.T
    kept, begins = ~fresh, fresh.any(axis=1).tolist()
    views = [owns, owns[:, : 2 * h], owns[:, :h], owns[:, h : 2 * h], owns[:, 2 * h :], candidates]
    if trace is None:
        views = [[x[0]] * steps for x in views]
    one, half = np.float32(1), np.float32(0.5)
    steps_ = zip(begins, states, states[1:], gates[:, : 2 * h], gates[:, 2 * h :], *views)
    for t, (begin, past, after, gate, gate_n, own, zr, z, r, inner, new) in enumerate(steps_):
        if begin:
            past *= kept[t]
        np.matmul(recur, past, out=own)
        np.add(zr, gate, out=zr)
        np.tanh(zr, out=zr)
        np.add(zr, one, out=zr)
        np.multiply(r, inner, out=new)
        np.add(new, gate_n, out=new)
        np.tanh(new, out=new)
        np.multiply(z, half, out=z)
        np.subtract(past, new, out=after)
        np.multiply(after, z, out=after)
        np.add(after, new, out=after)
    if trace is not None:
        trace.extend([states[:-1], owns[:, :h], owns[:, h : 2 * h], candidates, owns[:, 2 * h :]])
    return states[:-1].transpose(0, 2, 1), np.ascontiguousarray(states[-1].T)


def lived(values: np.ndarray, live: np.ndarray) -> np.ndarray:
    """The live tokens of a window one below another."""
    flat = values.reshape(live.size, *values.shape[2:])
    return flat if live.all() else flat[live.ravel()]


def _bounded(weights: np.ndarray) -> bool:
    """Whether no sum of a row's weights times states, which lie between -1 and 1, can be too large for ``exp``."""
    return bool(weights.size) and float((np.abs(weights) @ np.ones(weights.shape[1], np.float32)).max()) < 60


def _picked(x: np.ndarray, target: np.ndarray, bounded: bool, logs: np.ndarray | None) -> np.ndarray:
    """``logs`` gains the logarithm of the target's share in each row's softmax. ``x`` times what comes back becomes the gradient."""
    if not bounded:
        x -= x.max(axis=1)[:, None]
    flat, at = x.reshape(-1), np.arange(0, x.size, x.shape[1]) + target
    chosen = flat.take(at) if logs is not None else None
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], np.float32)
    flat[at] -= total
    if logs is not None:
        logs += chosen - np.log(total)
    return np.divide(-1, total, out=total)[:, None]


def outputs(
    model: Model, lexicon: Lexicon, states: np.ndarray, ids: np.ndarray, grads: dict | None = None, wanted: bool = True
) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Natural log-probabilities of tokens given their states, without the count of a word in its class of other words.

    With ``grads`` the gradients are added to it, and the gradient of the states comes back too; the log-probabilities
    are left out unless they are ``wanted``.
    """
    slope = grads is not None
    target, h, n = lexicon.class_of[ids], states.shape[1], len(ids)
    # Tokens stand in the order of their classes, one in each row. A state of one carries the biases.
    order = np.argsort(target, kind="stable")
    target, ids = target[order], ids[order]
    extended = np.empty((n, h + 1), np.float32)
    extended[:, :h] = states.take(order, axis=0)
    extended[:, h] = 1
    weights = np.concatenate([model.p["class_w"], model.p["class_b"][None]])
    bounded, across = _bounded(weights.T), np.ascontiguousarray(weights[:h].T)
    result = np.zeros(n) if wanted else None
    back = np.empty((n, h), np.float32) if slope else None
    for a in range(0, n, ROWS):
        x = extended[a : a + ROWS] @ weights
        scale = _picked(x, target[a : a + ROWS], bounded, result[a : a + ROWS] if wanted else None)
        if slope:
            found = (extended[a : a + ROWS] * scale).T @ x
            grads["class_w"] += found[:h]
            grads["class_b"] += found[h]
            np.multiply(x @ across, scale, out=back[a : a + ROWS])
    cuts = np.searchsorted(target, np.arange(lexicon.classes + 1)).tolist()
    weights = np.concatenate([model.p["word_w"], model.p["word_b"][:, None]], axis=1)
    bounded, of_words = _bounded(weights), np.zeros(weights.shape if slope else 0, np.float32)
    for first, last, others in lexicon.together if slope else lexicon.alone:
        low, high, a, b = lexicon.bounds[first], lexicon.bounds[last], cuts[first], cuts[last]
        if a == b:
            continue
        x = extended[a:b] @ weights[low:high].T
        if others is not None:
            x += others.take(target[a:b] - first, axis=0)
        scale = _picked(x, ids[a:b] - low, bounded, result[a:b] if wanted else None)
        if slope:
            x *= scale
            np.matmul(x.T, extended[a:b], out=of_words[low:high])
            back[a:b] += x @ model.p["word_w"][low:high]
    logs = np.empty(n) if wanted else None
    if wanted:
        logs[order] = result
    if slope:
        grads["word_w"] += of_words[:, :h]
        grads["word_b"] += of_words[:, h]
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        back = back.take(place, axis=0)
    return logs, back


def lanes_of(texts: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Numbers of the texts of each lane; dealt longest first, so that lanes are of about equal length."""
    ends: list[list] = [[0, i, []] for i in range(min(lanes, max(1, len(texts))))]
    for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
        lane = ends[0]
        lane[2].append(i)
        heapq.heapreplace(ends, [lane[0] + len(texts[i]), lane[1], lane[2]])
    return [lane[2] for lane in ends]


def windows(texts: list[np.ndarray], count: int, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of all lanes: ids, where texts begin, each token's text (-1: a lane is at its end), and the lanes."""
    lanes = sorted(lanes_of(texts, count), key=lambda lane: -sum(len(texts[i]) for i in lane))
    order = [i for lane in lanes for i in lane]
    lengths = np.array([len(texts[i]) for i in order], np.int64)
    flat = np.concatenate([texts[i] for i in order]) if order else np.zeros(0, np.int32)
    owner = np.repeat(np.array(order, np.int32), lengths)
    begins = np.zeros(len(flat), bool)
    begins[np.cumsum(lengths)[lengths > 0] - lengths[lengths > 0]] = True
    size = np.array([sum(len(texts[i]) for i in lane) for lane in lanes], np.int64)
    first = np.cumsum(size) - size
    for start in range(0, int(size.max(initial=0)), settings.window):
        stop = min(int(size[0]), start + settings.window)
        active = np.arange(int((size > start).sum()))  # the longest lanes come first
        at = np.arange(start, stop)[:, None]
        place = first[active] + at
        if stop <= size[active[-1]]:
            yield flat.take(place), begins.take(place), owner.take(place), active
            continue
        live = at < size[active]
        place = np.where(live, place, 0)
        yield np.where(live, flat[place], 0), live & begins[place], np.where(live, owner[place], -1), active


def score(model: Model, lexicon: Lexicon, texts: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Natural log-probability of each coded text, its classes of other words without their counts."""
    result = np.zeros(len(texts))
    state = np.zeros((settings.lanes, settings.hidden), np.float32)
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    weights = halved(model)

    def put_out() -> None:
        states, ids, who = (np.concatenate(x) for x in zip(*held))
        held.clear()
        result[:] += np.bincount(who, outputs(model, lexicon, states, ids)[0], len(texts))

    for ids, fresh, who, active in windows(texts, settings.lanes, settings):
        before, state[active] = forward(model, state[active], ids, fresh, weights=weights)
        live = who >= 0
        held.append((lived(before, live), lived(ids, live), lived(who, live)))
        if sum(len(x[1]) for x in held) >= CHUNK:
            put_out()
    if held:
        put_out()
    return result


def summed(rows: np.ndarray, order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ones of the sorted ``keys``, and for each the sum of its rows, which ``order`` names. Rows are of even width.

    Most keys have few rows: the first rows of all keys are added at once, then the second ones, and only what is left of
    the frequent keys is summed key by key.
    """
    cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    sizes = np.diff(np.append(cuts, len(keys)))
    by_size = np.argsort(-sizes, kind="stable")
    cuts, sizes = cuts[by_size], sizes[by_size]
    total = rows.take(order[cuts], axis=0)
    for k in range(1, LAYERS):
        n = int(np.searchsorted(-sizes, -k))  # keys with more than k rows
        total[:n] += rows.take(order[cuts[:n] + k], axis=0)
    n = int(np.searchsorted(-sizes, -LAYERS))
    if n:
        sizes = sizes[:n] - LAYERS
        ends = np.cumsum(sizes)
        left = np.arange(ends[-1]) + np.repeat(cuts[:n] + LAYERS - ends + sizes, sizes)
        pairs = rows.take(order[left], axis=0).view(np.complex64)  # two numbers at once
        total[:n] += np.add.reduceat(pairs, ends - sizes, axis=0).view(np.float32)
    return keys[cuts].astype(np.int64), total


class Trainer:
    """Adagrad on one copy of the model; the state is carried between windows, gradients are not."""

    def __init__(self, model: Model, lexicon: Lexicon, settings: Settings):
        self.model, self.lexicon, self.settings, self.tokens = model, lexicon, settings, 0
        self.squares = {k: np.full(v.shape, START, np.float32) for k, v in model.p.items()}

    def fit(self, texts: list[np.ndarray]) -> None:
        lanes = self.settings.train_lanes
        state = np.zeros((lanes, self.settings.hidden), np.float32)
        for ids, fresh, who, active in windows(texts, lanes, self.settings):
            state[active] = self.step(state[active], ids, fresh, who >= 0)

    def step(self, state: np.ndarray, ids: np.ndarray, fresh: np.ndarray, live: np.ndarray) -> np.ndarray:
        p, h, n = self.model.p, self.settings.hidden, int(live.sum())
        grads = {k: np.zeros_like(v) for k, v in p.items() if k != "table"}
        trace: list = []
        before, after = forward(self.model, state, ids, fresh, trace)
        states, used = before.reshape(-1, h), lived(ids, live)
        _, towards = outputs(self.model, self.lexicon, lived(states.reshape(before.shape), live), used, grads, wanted=False)
        if n < live.size:
            every = np.zeros((live.size, h), np.float32)
            every[live.ravel()] = towards
            towards = every
        towards = np.ascontiguousarray(towards.reshape(*live.shape, h).transpose(0, 2, 1))
        # Slopes of the candidate's recurrent part (twice them), of both gates' arguments and of the candidate's argument.
        parts = np.empty((len(ids), 4, h, len(state)), np.float32)
        one, half = np.float32(1), np.float32(-0.5)
        for first in range(0, len(ids), 8):  # as many steps as stay in a core's cache
            past, z, r, new, own = (x[first : first + 8] for x in trace)
            to_own, to_z, to_r, to_new = (parts[first : first + 8, i] for i in range(4))
            rest, some = one - z, new * new
            np.subtract(one, some, out=some)
            np.multiply(some, rest, out=to_new)
            np.subtract(past, new, out=some)
            np.multiply(some, z, out=some)
            np.multiply(some, rest, out=to_z)
            np.multiply(r, half, out=some)
            np.add(some, one, out=some)
            np.multiply(some, own, out=some)
            np.multiply(to_new, r, out=rest)
            np.multiply(rest, some, out=to_r)
            to_own[:] = rest
        kept, begins = ~fresh, fresh.any(axis=1).tolist()
        recur = np.concatenate([p["recur"][:, 2 * h :] * -half, p["recur"][:, : 2 * h]], axis=1)
        carried, more = np.zeros((2, h, len(state)), np.float32)  # the first: slopes of the state after each step
        rows = np.empty((len(ids), len(state), 4 * h), np.float32)
        steps = zip(parts, parts.reshape(len(ids), 4 * h, -1), rows.transpose(0, 2, 1), trace[1], towards, kept, begins)
        for part, flat, row, z, toward, keep, begin in reversed(list(steps)):
            np.multiply(part, carried, out=part)
            np.matmul(recur, flat[: 3 * h], out=more)
            np.multiply(carried, z, out=carried)
            np.add(carried, more, out=carried)
            np.add(carried, toward, out=carried)
            row[:] = flat
            if begin:
                np.multiply(carried, keep, out=carried)
        rows = rows.reshape(-1, 4 * h)
        found = sum(states[i : i + 512].T @ rows[i : i + 512, : 3 * h] for i in range(0, len(rows), 512))
        grads["recur"][:, : 2 * h] = found[:, h:]
        np.multiply(found[:, :h], -half, out=grads["recur"][:, 2 * h :])
        used = used.astype(np.uint16 if len(p["table"]) <= 1 << 16 else np.int64)
        order = np.argsort(used, kind="stable")
        inputs, table = summed(rows, order if n == live.size else np.flatnonzero(live)[order], used[order])
        table = table[:, h:]
        for k, g in grads.items():
            p[k] += self._move(g, n, self.squares[k])
        squares = self.squares["table"][inputs]
        p["table"][inputs] += self._move(table, n, squares)
        self.squares["table"][inputs] = squares
        self.tokens += n
        return after

    def _move(self, slope: np.ndarray, n: int, squares: np.ndarray) -> np.ndarray:
        """By how much parameters move, given the sum of slopes over ``n`` tokens; ``squares`` gains their squares."""
        slope /= n
        squares += slope * slope
        slope /= np.sqrt(squares)
        slope *= self.settings.rate
        return slope


# --- over Spark ----------------------------------------------------------------------------------------------------

_HELD: dict[str, tuple] = {}


def _opened(shared, settings: Settings) -> tuple[Lexicon, Model]:
    """The broadcast lexicon and model, opened once in each worker."""
    value = shared.value
    if value["name"] not in _HELD:
        _HELD.clear()
        lexicon = Lexicon(value["words"].split(" ") if value["counts"].size else [], value["counts"], value["endings"], value["masses"], settings)
        _HELD[value["name"]] = lexicon, Model(lexicon, settings).load(value["flat"]) if value["flat"] is not None else Model(lexicon, settings)
    return _HELD[value["name"]]


def ended(codes: np.ndarray, offsets: np.ndarray, lexicon: Lexicon) -> list[np.ndarray]:
    """The codes of each text, followed by that of its end."""
    codes = np.insert(codes, offsets[1:], lexicon.code(END))
    bounds = offsets + np.arange(len(offsets))
    return [codes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def coded_texts(column: pa.Array, lexicon: Lexicon) -> list[np.ndarray]:
    """``Coded(column, lexicon).texts``, for training, which needs no dictionary of the batch."""
    flat, offsets = split_words(column)
    return ended(lexicon.codes(flat), offsets, lexicon)


class Coded:
    """A batch as codes of the lexicon: ``texts`` with their ends, and what the dictionary of the batch says of words."""

    def __init__(self, column: pa.Array, lexicon: Lexicon):
        flat, offsets = split_words(column)
        coded = flat.dictionary_encode()
        self.dictionary = coded.dictionary
        self.index, self.offsets = coded.indices.to_numpy(), offsets
        self.codes = lexicon.codes(self.dictionary)
        self.texts = ended(self.codes[self.index], offsets, lexicon)


def grouped(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut at about ``size`` bytes of text: many texts side by side fill the lanes, and memory stays bounded."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        while at < batch.num_rows:
            to = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), size, "right")))
            yield batch.slice(at, to - at)
            at = to
        del batch  # its memory is free before the next one comes


def _average(parts: DataFrame) -> DataFrame:
    """``block, tokens, values`` of the same blocks: means weighted by tokens."""

    def mean(group: pa.Table) -> pa.Table:
        weights = group.column("tokens").to_numpy()
        total = None
        for weight, values in zip(weights, group.column("values")):
            values = weight * np.frombuffer(values.as_py(), np.float32).astype(np.float64)
            total = values if total is None else total + values
        packed = (total / weights.sum()).astype(np.float32).tobytes()
        return pa.table({"block": group.column("block").slice(0, 1), "part": pa.array([0], pa.int32()), "tokens": [float(weights.sum())], "values": [packed]})

    schema = "block int, part int, tokens double, values binary"
    some = parts.groupBy("block", "part").applyInArrow(mean, schema)  # some hundred copies at a time
    return some.groupBy("block").applyInArrow(mean, schema)


def train(docs: DataFrame, base: dict, settings: Settings, tokens: int) -> dict:
    """``base`` (lexicon for the broadcast) with the trained parameters in ``flat``.

    A round has as many copies as its share of the ``tokens`` asks for, however many cores there are, so a lost
    executor repeats no more than a copy's texts.
    """
    context = docs.sparkSession.sparkContext
    block, copies_of_round = 16_384, max(1, -(-tokens // (settings.rounds * settings.task)))
    for turn in range(settings.rounds):
        shared = context.broadcast(base)

        def fit(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lexicon, start = _opened(shared, settings)
            trainer = Trainer(Model(lexicon, settings).load(start.flat()), lexicon, settings)
            key = 0
            for part in grouped(batches, 0, settings.group):
                key = part.column(1)[0].as_py() >> 33 & 63  # the upper bits of a row number are its partition
                trainer.fit(coded_texts(part.column(0), lexicon))
            if trainer.tokens:
                flat = trainer.model.flat()
                cuts = range(0, len(flat), block)
                values = [flat[i : i + block].tobytes() for i in cuts]
                n = len(values)
                columns = [pa.array(range(n), pa.int32()), pa.array([key] * n, pa.int32()), pa.array([float(trainer.tokens)] * n), pa.array(values)]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "tokens", "values"])

        mine = docs.filter(F.pmod(F.xxhash64("row"), F.lit(settings.rounds)) == turn).select("text", "row")
        copies = common.stored(mine.coalesce(copies_of_round).mapInArrow(fit, "block int, part int, tokens double, values binary"), "copies")
        found = sorted((r["block"], r["values"]) for r in _average(copies).collect())  # one row for each block of the model
        if found:
            base = {**base, "flat": np.frombuffer(b"".join(v for _, v in found), np.float32), "name": f"{base['name']}+{turn}"}
    return base


def score_documents(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from rows that are not ``held_out``. A null or empty text is its end alone. Repeated rows and ids
    count each; a null doc_id stays. Without training rows every score is that of a single word. An empty table
    gives no rows. Other columns are ignored.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), held_out.alias("held_out"), "text")
    training = rows.filter(~F.col("held_out"))
    counts = common.stored(word_counts(training), "counts")
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    least = least_held(counts, n)
    frequent = counts.filter((F.col("n") >= least) | (F.col("word") == END)).toArrow()  # at most HELD or 1 / COMMON rows, and the end
    words, numbers = frequent.column("word").to_pylist(), frequent.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda i: (-numbers[i], words[i]))
    words, numbers = [words[i] for i in order], numbers[order]
    ending = F.substring("word", -2, 2)
    own = docs.sparkSession.createDataFrame([(w,) for w in words[: settings.words]], "word string")
    others = counts.join(F.broadcast(own), "word", "left_anti")
    others = others.groupBy(ending.alias("ending")).agg(F.sum(F.col("n") + 1).alias("mass"))
    others = common.stored(others, "endings")
    top = others.orderBy(F.desc("mass"), "ending").limit(settings.endings).collect()
    every = others.agg(F.sum("mass").alias("m")).first()["m"] or 0
    masses = np.array([r["mass"] for r in top] + [every - sum(r["mass"] for r in top)], np.float64) + 1
    base = {"name": str(id(counts)) + counts.inputFiles()[0] if n else "none", "words": " ".join(words), "counts": numbers, "endings": [r["ending"] for r in top], "masses": masses, "flat": None}
    base = train(training, base, settings, n)
    shared = context.broadcast(base)
    unit = math.log10(n + v + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, model = _opened(shared, settings)
        class_log = np.concatenate([np.zeros(lexicon.own), np.log10(lexicon.masses)])
        for part in grouped(batches, 3, settings.group):
            coded = Coded(part.column(3), lexicon)
            logs = score(model, lexicon, coded.texts, settings) / math.log(10)
            # What each word of the batch adds to the base score and, for other words, to the model's.
            known = lexicon.counts(pa.concat_arrays([coded.dictionary, pa.array([END], pa.large_string())]))
            known, end = known[:-1], int(known[-1])
            word_log = np.where(known >= 0, np.log10(np.maximum(known, 0) + 1.0), 0.0)
            base_log = word_log - unit
            more = np.where(coded.codes < lexicon.own, 0.0, word_log - class_log[coded.codes])
            end_code = lexicon.code(END)
            end_log = math.log10(end + 1) if end >= 0 else 0.0
            sums = lambda values: np.append(0, np.cumsum(values[coded.index]))
            a, b = coded.offsets[:-1], coded.offsets[1:]
            base_sum, more_sum, known_sum = sums(base_log), sums(more), sums((known >= 0).astype(np.int64))
            # Words that the broadcast does not hold, by text: each once, with how often it occurs there.
            at = np.flatnonzero((known < 0)[coded.index])
            text = np.searchsorted(coded.offsets, at, "right") - 1
            found, times = np.unique(text * max(1, len(known)) + coded.index[at], return_counts=True)
            text, word = np.divmod(found, max(1, len(known)))
            listed = [coded.dictionary.take(pa.array(word)).cast(pa.string()), pa.array(times.astype(np.int64))]
            firsts = pa.array(np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32))
            rare = pa.ListArray.from_arrays(firsts, pa.StructArray.from_arrays(listed, ["word", "times"]))
            columns = [
                *part.columns[:3],
                pa.array(b - a + 1, pa.int64()),
                pa.array(known_sum[b] - known_sum[a] + (end > 0), pa.int64()),
                pa.array(base_sum[b] - base_sum[a] + end_log - unit),
                pa.array(logs + more_sum[b] - more_sum[a] + (0.0 if end_code < lexicon.own else end_log - class_log[end_code])),
                rare,
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_SCORED_NAMES)

    scored = common.stored(rows.mapInArrow(run, _SCORED), "scored")
    rare = counts.filter((F.col("n") < least) & (F.col("word") != END)).hint("shuffle_hash")  # a row for each word: nothing needs sorting
    listed = scored.select("row", F.explode("rare").alias("x")).select("row", F.col("x.word").alias("word"), F.col("x.times").alias("times"))
    gain = F.sum(F.col("times") * F.log10(F.col("n") + 1))
    gains = listed.join(rare, "word").groupBy("row").agg(gain.alias("gain"), F.sum("times").alias("seen"))
    gained = F.coalesce("gain", F.lit(0.0))
    return scored.join(gains, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_score") + gained).alias("base_score"),
        (F.col("score") + gained).alias("score"),
    )


_SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
    "rare array<struct<word:string,times:bigint>>"
)
_SCORED_NAMES = [x.split()[0] for x in _SCORED.split(", ")]
