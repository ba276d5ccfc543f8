"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its emission scores are linear in features of the line and of its neighbours; transitions score
neighbouring labels. Forward-backward gives each line's probability of being good, and the mean of these over a
document, weighted by the length of lines, its quality; two numbers fitted on training documents calibrate it.

Labels are of documents, so in training each line takes its document's label. The field is fitted in numpy on a bounded
sample of labelled documents, chosen by hash; all documents are scored whole.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common

#: Labelled documents and lines of each on which the field is fitted; scoring has no such bounds.
SAMPLE = 5_000
SAMPLE_LINES = 60
STEPS = 120
RATE = 0.1
DECAY = 1e-4
LIMIT = 0.3

#: Classes of bytes whose shares of a line are features.
_GROUPS = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "stop": b".,;:",
    "call": b"!?",
    "symbol": b"#*$%&",
    "bar": b"|",
    "mark": b"<>{}[]()\\/=_~^@+",
    "quote": b"\"'`-",
}


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, len(_GROUPS) + 1), np.int32)
    for column, group in enumerate(_GROUPS.values()):
        table[list(group), column] = 1
    table[128:, len(_GROUPS)] = 1  # bytes beyond ASCII
    return table


_CLASSES = _byte_classes()
_CLASS_OF = np.where(_CLASSES.any(axis=1), _CLASSES.argmax(axis=1), _CLASSES.shape[1]).astype(np.uint8)
OWN = _CLASSES.shape[1] + 9
WIDTH = 3 * OWN + 3


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines with a word, the weight (bytes) of each, and where each text's lines begin and end.

    A text without words has no lines.
    """
    data, starts, stops, bounds, repeated, again = bytearray(), [], [], [0], [], []
    for text in texts:
        seen: set[bytes] = set()
        for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
            own_words = line.split()
            if own_words:
                again.append(sum(map(operator.eq, own_words[1:], own_words)) / len(own_words))
                starts.append(len(data))
                data += line
                stops.append(len(data))
                data += b"\n"
                repeated.append(line in seen)
                seen.add(line)
        bounds.append(len(starts))
    n = len(starts)
    if not n:
        return np.zeros((0, WIDTH), np.float32), np.zeros(0), np.array(bounds)
    codes = np.frombuffer(bytes(data), np.uint8)
    first, last = np.array(starts), np.array(stops)
    kinds = _CLASS_OF[codes]
    columns = _CLASSES.shape[1]
    line_of = np.repeat(np.arange(n), np.diff(np.append(first, len(codes))))
    counts = np.bincount(line_of * (columns + 1) + kinds, minlength=n * (columns + 1)).reshape(n, columns + 1)[:, :columns]
    length = (last - first).astype(np.float64)
    names = list(_GROUPS)
    blank = kinds == names.index("blank")
    edge = codes == 10  # the end of a line also ends its last word
    word_end = (blank | edge)[1:] & ~(blank | edge)[:-1]
    word_start = ~(blank | edge) & np.append(True, (blank | edge)[:-1])
    words = np.maximum(1, np.bincount(line_of[:-1][word_end], minlength=n))
    noisy = np.isin(kinds, [names.index("symbol"), names.index("call")])
    bad_ends = np.bincount(line_of[:-1][word_end & noisy[:-1]], minlength=n)
    upper_starts = np.bincount(line_of[word_start & (kinds == names.index("upper"))], minlength=n)
    at_end = codes[last - 1]
    own = np.column_stack(
        [
            counts / length[:, None],
            np.log1p(length) / 8,
            np.log1p(words) / 6,
            (length - counts[:, names.index("blank")]) / words / 10,
            bad_ends / words,
            upper_starts / words,
            np.isin(at_end, list(b".!?\"'")),
            counts[:, names.index("upper")] / np.maximum(1, counts[:, names.index("upper")] + counts[:, names.index("lower")]),
            np.array(repeated),
            np.array(again),
        ]
    )
    begin, end = np.zeros(n, bool), np.zeros(n, bool)
    edges = np.array(bounds)
    begin[edges[:-1][edges[:-1] < edges[1:]]] = True
    end[edges[1:][edges[:-1] < edges[1:]] - 1] = True
    before = np.vstack([np.zeros((1, OWN)), own[:-1]]) * ~begin[:, None]
    after = np.vstack([own[1:], np.zeros((1, OWN))]) * ~end[:, None]
    return np.column_stack([own, before, after, begin, end, np.ones(n)]).astype(np.float32), length, edges


@dataclass
class Field:
    """``weights`` score a line as good against bad; ``moves`` score neighbours (bad/good before, bad/good after)."""

    weights: np.ndarray
    moves: np.ndarray
    calibration: tuple[float, float] = (1.0, 0.0)


def marginals(score: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability that each line is good, expected moves (summed, 2 x 2), and log-normaliser of each document.

    Documents go side by side, longest first; a step handles one line of each that is still running.
    """
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    running = np.searchsorted(-sizes, -np.arange(longest), side="left")  # documents with more than t lines
    ahead, scale = np.zeros((len(score), 2)), np.zeros(len(score))
    behind = np.ones((len(score), 2))
    step = np.exp(moves)
    local = np.column_stack([np.exp(-score / 2), np.exp(score / 2)])
    for t in range(longest):
        at = starts[: running[t]] + t
        value = local[at] * (ahead[at - 1] @ step if t else 1.0)
        scale[at] = value.sum(axis=1)
        ahead[at] = value / scale[at, None]
    for t in range(longest - 2, -1, -1):
        at = starts[: running[t + 1]] + t
        value = (behind[at + 1] * local[at + 1]) @ step.T
        behind[at] = value / value.sum(axis=1, keepdims=True)
    both = ahead * behind
    good = both[:, 1] / both.sum(axis=1)
    expected = np.zeros((2, 2))
    inner = np.ones(len(score), bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    at = np.flatnonzero(inner)
    if len(at):
        pair = ahead[at - 1][:, :, None] * step[None] * (local[at] * behind[at])[:, None, :]
        expected = (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    return good, expected, np.log(scale)


def fit(features: np.ndarray, length: np.ndarray, bounds: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum conditional likelihood by Adam, each line labelled as its document; then the calibration."""
    sizes = np.diff(bounds)
    target = np.repeat(labels, sizes).astype(np.float64)
    observed = np.zeros((2, 2))
    for value in (0, 1):
        observed[value, value] = np.maximum(sizes[labels == value] - 1, 0).sum()
    weights, moves, n = np.zeros(features.shape[1]), np.zeros((2, 2)), max(1, len(target))
    theta = np.zeros(len(weights) + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        good, expected, _ = marginals(features @ weights, moves, bounds)
        gradient = np.concatenate([features.T @ (target - good) / n - DECAY * weights, ((observed - expected) / n - DECAY * moves).ravel()])
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta = theta + RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        weights, moves = theta[:-4], theta[-4:].reshape(2, 2)
    field = Field(weights, moves)
    raw = quality(field, features, length, bounds)
    field.calibration = calibrate(_logit(raw), labels)
    return field


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def calibrate(x: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression with a weak prior, by Newton steps. The slope stays positive."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p)
        gradient = np.array([((labels - p) * x).sum() - 0.1 * (a - 1), (labels - p).sum() - 0.01 * b])
        hessian = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        move = np.clip(np.linalg.solve(hessian, gradient), -1, 1)
        a, b = max(1e-3, a + move[0]), b + move[1]
    return float(a), float(b)


def quality(field: Field, features: np.ndarray, length: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean probability of a good line, weighted by length; one half for a text without lines."""
    good = marginals(features @ field.weights, field.moves, bounds)[0]
    sums = lambda x: np.diff(np.append(0, np.cumsum(x))[bounds])
    total = sums(length)
    return np.where(total > 0, sums(good * length) / np.maximum(total, 1e-9), 0.5)


def score(field: Field, texts: list[str | None]) -> np.ndarray:
    out = []
    for start in range(0, len(texts), 1_000):
        raw = quality(field, *line_features(texts[start : start + 1_000]))
        a, b = field.calibration
        out.append(1 / (1 + np.exp(-(a * _logit(raw) + b))))
    return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Field:
    """A field learned from rows of ``docs`` where ``learn`` holds and ``labels`` (doc_id, quality) has one label.

    About ``sample`` documents are used, at most twice as many, chosen by hash; of each at most ``SAMPLE_LINES`` lines count,
    taken around a place that the hash fixes. Without labelled rows every line is as likely good as bad.
    """
    one = labels.filter("quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("high"))
    known = one.filter("quality = high").select("doc_id", "quality")
    labelled = common.stored(docs.filter(learn).select("doc_id").join(known, "doc_id").distinct(), "labelled")
    chosen = common.stored(common.bounded_sample(labelled, "doc_id", sample), "chosen")
    # The sample is bounded, so its ids can be broadcast, and no text moves but theirs.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("int"), F.xxhash64("doc_id").alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            features, length, bounds = line_features(batch.column(0).to_pylist())
            out = []
            for i, h in enumerate(batch.column(2).to_pylist()):
                a, b = bounds[i], bounds[i + 1]
                if b - a > SAMPLE_LINES:
                    a += h % (b - a - SAMPLE_LINES)
                    b = a + SAMPLE_LINES
                out.append((features[a:b].tobytes(), length[a:b].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, pa.binary()) for c in zip(*out))], names=["quality", "features", "length"])

    # Sorted, as sums of floating-point numbers depend on the order.
    got = [r for r in rows.mapInArrow(run, "quality int, features binary, length binary").toLocalIterator() if len(r["length"])]
    got.sort(key=lambda r: (bytes(r["length"]), r["quality"], bytes(r["features"])))
    if not got:
        return Field(np.zeros(WIDTH), np.zeros((2, 2)))
    features = np.concatenate([np.frombuffer(r["features"], np.float32).reshape(-1, WIDTH) for r in got])
    length = np.concatenate([np.frombuffer(r["length"], np.float64) for r in got])
    bounds = np.append(0, np.cumsum([len(r["length"]) // 8 for r in got]))
    return fit(features, length, bounds, np.array([r["quality"] for r in got]))


def classify(docs: DataFrame, field: Field, limit: float = LIMIT) -> DataFrame:
    """One row for each row of ``docs``: doc_id, score (0 to 1) and predicted (1 if the score reaches ``limit``).

    Only the text counts. Null, empty and blank texts have no lines and get the calibrated score of one half.
    Repeated rows and null ids are scored each. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = score(field, batch.column(1).to_pylist())
                columns = [batch.column(0).cast(pa.int64()), pa.array(values), pa.array((values >= limit).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int")


def keep(docs: DataFrame, labels: DataFrame, learn: Column, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs`` whose text is predicted good; columns as given."""
    field = train(docs, labels, learn)
    good = F.pandas_udf(lambda texts: _predicted(field, texts, limit), "boolean")
    return docs.filter(good("text"))


def _predicted(field: Field, texts, limit: float):
    import pandas as pd

    return pd.Series(score(field, list(texts)) >= limit, index=texts.index)
