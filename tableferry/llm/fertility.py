"""Quality rules: tokeniser fertility of whole texts against bands of their language.

A public vocabulary with byte fallback measures tokens per word (the fertility), characters per token, the share of
tokens that are single bytes, and the entropy of the tokens. For each language the median and the median absolute deviation over all documents that
pass the base rules give the bands; a document outside one is rejected. Short texts scatter more and have wider bands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.llm import common, vocabulary

#: The symbols and the base rules of the query contract.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEAT_SHARE = 50
#: Half the width of a band in robust standard deviations; tokens at which a band is twice as wide.
WIDTH = 6.0
SHORT = 100
#: Robust standard deviations that a band has at least, so that a language of like texts keeps its scatter.
FLOOR = {"tokens_per_word": 0.05, "chars_per_token": 0.04, "entropy": 0.05, "byte_share": 0.02}
#: Ids of the vocabulary's 256 byte tokens, and those of white space among them.
BYTE_IDS = (3, 258)
SPACE_IDS = (12, 13, 14, 15, 16)

_BLANKS = re.compile(r"[\x20\x09-\x0D]+")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words in windows of ``width`` words that are found twice or more, the first time included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    key = codes[:n].copy()
    for step in range(1, width):  # renumbered at each step, so that keys stay exact
        _, key = np.unique(key * len(number) + codes[step : n + step], return_inverse=True)
    starts = np.flatnonzero(np.bincount(key)[key] > 1)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + width, -1)
    return int(np.count_nonzero(np.cumsum(marks)))


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; a null text has none."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in common.SPACE)
    lines = [x for x in text.split("\n") if x.strip(common.SPACE)]
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def token_measures(packed: bytes) -> tuple[int, float, float]:
    """Tokens, share of byte tokens (white space apart), entropy as a share of the greatest for so many tokens."""
    ids = np.frombuffer(packed, "<u4")
    if not len(ids):
        return 0, 0.0, 0.0
    seen = np.bincount(ids)
    low, high = BYTE_IDS
    single = seen[low : high + 1].sum() - sum(seen[i] for i in SPACE_IDS if i < len(seen))
    p = seen[seen > 0] / len(ids)
    return len(ids), float(single / len(ids)), float(-(p * np.log2(p)).sum() / np.log2(max(2, len(ids))))


_MEASURED = (
    "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, byte_share double, entropy double"
)


def measures(docs: DataFrame, path: str | None = None, carry: bool = False) -> DataFrame:
    """The counts and token measures of each row; ``base_failed`` follows the base rules.

    ``carry``: the row itself comes along in a struct ``whole``, so that it need not be joined again.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = vocabulary.piece_bpe(path).encode
        for batch in batches:
            text = batch.column(2).field("text") if carry else batch.column(2)
            texts = text.to_pylist()
            if not texts:
                continue
            base = list(zip(*map(counts, texts)))
            token = list(zip(*map(token_measures, encode(text))))
            kinds = [pa.int64()] * 6 + [pa.float64()] * 2
            columns = [pa.array(x, t) for x, t in zip([*base, *token], kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns, *batch.columns[2:][:carry]], names=[*_NAMES, *["whole"][: carry]])

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    text = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("whole") if carry else F.col("text")
    rows = docs.select(F.col("doc_id").cast("long"), lang.alias("lang"), text)
    schema = T.StructType.fromDDL(_MEASURED)
    if carry:
        schema = schema.add("whole", docs.schema)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))
    per_token = F.col("word_chars") / F.greatest(F.col("n_tokens"), F.lit(1))
    per_word = F.col("n_tokens") / F.greatest(F.col("n_words"), F.lit(1))
    measured = rows.mapInArrow(of, schema).withColumn("base_failed", failed)
    return measured.withColumn("chars_per_token", per_token).withColumn("tokens_per_word", per_word)


_NAMES = [x.split()[0] for x in _MEASURED.split(", ")]
_BANDED = ("tokens_per_word", "chars_per_token", "entropy", "byte_share")


def bands(measured: DataFrame) -> DataFrame:
    """``lang`` with centre and deviation of each measure over all rows that pass the base rules.

    The quantiles are mergeable sketches, so a language with any number of rows is folded before the shuffle.
    """
    quartiles = {m: F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(m) for m in _BANDED}
    found = measured.filter("not base_failed").groupBy("lang").agg(*quartiles.values())
    columns = []
    for m in _BANDED:
        spread = (F.col(m)[2] - F.col(m)[0]) / 1.349  # of a normal distribution's quartiles
        columns += [F.col(m)[1].alias(f"{m}_mid"), F.greatest(spread, F.lit(FLOOR[m])).alias(f"{m}_dev")]
    return found.select("lang", *columns)


def judge(docs: DataFrame, width: float = WIDTH, path: str | None = None, carry: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, counts, measures, base_failed and kept; with ``carry`` also ``whole``.

    A null text has no words and fails the base rules, as does an empty one; a null ``lang``, or a table without the
    column, is a language of its own. Repeated rows and ids are judged each. Bands of a language come from its own
    rows, whatever their number; ties at a band's edge are kept. An empty table gives no rows.
    """
    measured = common.stored(measures(docs, path, carry), "measures")
    found = bands(measured)
    rows = measured.join(F.broadcast(found) if _few(measured) else found, "lang", "left")
    wide = width * (1 + F.sqrt(SHORT / F.greatest(F.col("n_tokens"), F.lit(1))))
    inside = F.lit(True)
    for m, sides in (("tokens_per_word", (1,)), ("chars_per_token", (-1, 1)), ("entropy", (-1,)), ("byte_share", (1,))):
        for side in sides:
            inside &= side * (F.col(m) - F.col(f"{m}_mid")) <= wide * F.col(f"{m}_dev")
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True))).drop(*[f"{m}_{x}" for m in _BANDED for x in ("mid", "dev")])


#: Languages up to which the table of bands (some 60 bytes a row) is broadcast.
MOST_BROADCAST = 100_000


def _few(measured: DataFrame) -> bool:
    return measured.select("lang").distinct().count() <= MOST_BROADCAST


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept; columns as given."""
    return judge(docs, carry=True).filter("kept").select("whole.*")
