"""Tokens of two public vocabularies laid side by side.

Tokens of a block of texts are laid out on one axis of bytes, keyed by document. ``merge_asof`` finds for each token's
start the token of the other side that covers it; both directions together give all overlaps, and overlaps that end
at the same byte close a group. Every token of a group is linked with every token of the other side in it.

How many documents hold a pair of ids is counted over all blocks: a block has each of its pairs once, with the number
of its documents. Counts return to the blocks by pair, so neither step moves a row for each token, and no pair stands
in more rows than there are blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm import common, vocabulary

#: Bytes of text that are aligned together; a longer text is a block of its own.
BLOCK = 1 << 20
#: Links that are spread out at once.
LINKS = 1 << 21
#: From this many links on a group's equal ids are folded before they meet.
FOLD = 256

_PER_DOC = ("n_a", "n_b", "n_groups", "n_links")
_SCHEMA = (
    "block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, n_pairs array<long>, pairs binary, weights binary, codes array<long>, holders array<long>"
)
_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Side:
    """One vocabulary: ``encode``, and what stands behind an id: its bytes, and its number with each separator."""

    def __init__(self, encode, pieces: list[bytes], inner: str, last: str):
        self.encode = encode
        self.bytes = pa.array(pieces, pa.large_binary())
        self.size = len(pieces)
        self.labels = [f"{i}{inner}".encode() for i in range(self.size)] + [f"{i}{last}".encode() for i in range(self.size)]


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(1)
def sides(a_path: str | None, b_path: str | None) -> tuple[Side, Side, pa.Array]:
    """Both vocabularies, opened once for each worker, and the labels of ids in a group's text form."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    model, alphabet = Tokenizer.from_file(a_path), byte_alphabet()
    entries = [b""] * model.get_vocab_size()
    for token, number in model.get_vocab().items():
        entries[number] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
    a = Side(vocabulary.byte_bpe(a_path).encode, entries, ",", "|")
    pieces = sentencepiece.SentencePieceProcessor(model_file=b_path)
    signs = [
        bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
        for i in range(pieces.get_piece_size())
    ]
    b = Side(vocabulary.piece_bpe(b_path).encode, signs, ",", ";")
    return a, b, pa.array([*a.labels, *b.labels], pa.large_binary())


def _laid_out(side: Side, encoded: list[bytes], texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, their document, the length of their bytes, and which documents the bytes give back."""
    ids = np.frombuffer(b"".join(encoded), "<u4").astype(np.int64)
    counts = np.array([len(x) // 4 for x in encoded], np.int64)
    joined = side.bytes.take(pa.array(ids))
    offsets = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset : joined.offset + len(ids) + 1]
    data = memoryview(joined.buffers()[2] or b"").cast("B")
    ends = np.append(0, np.cumsum(counts))
    bounds = offsets[ends].tolist()
    same = np.array([data[p:q] == t for p, q, t in zip(bounds[:-1], bounds[1:], texts)], bool)
    return ids, np.repeat(np.arange(len(encoded)), counts), np.diff(offsets), same


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of tokens (numbers ``a``, ``b``) that share a byte.

    Each side has ``doc, at, end`` and its number, in the order of ``at``. Each start meets the token that covers it; a
    pair whose tokens start together is found from both sides and is taken from the first alone.
    """
    from_a = pd.merge_asof(a, b, on="at", by="doc", suffixes=("_a", "_b"))
    from_b = pd.merge_asof(b.assign(start=b["at"]), a.assign(begins=a["at"]), on="at", by="doc", suffixes=("_b", "_a"))
    columns = ["doc", "a", "b", "end_a", "end_b"]
    return pd.concat([from_a[columns], from_b.loc[from_b["start"] != from_b["begins"], columns]])


def _groups(frame: pd.DataFrame, closing: np.ndarray) -> np.ndarray:
    """The group of each token: how many tokens before it close one."""
    closes = np.zeros(len(frame), np.int64)
    closes[closing] = 1
    return np.cumsum(closes) - closes


def _folded(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and how often it stands there; equal ids of ``large`` groups are one row."""
    weights = np.ones(len(ids), np.int64)
    fold = large[group]
    if not fold.any():
        return group, ids, weights
    few = pd.DataFrame({"g": group[fold], "i": ids[fold]}).groupby(["g", "i"], sort=False).size().reset_index(name="n")
    group, ids = np.append(group[~fold], few["g"]), np.append(ids[~fold], few["i"])
    weights = np.append(weights[~fold], few["n"])
    order = np.argsort(group, kind="stable")
    return group[order], ids[order], weights[order]


def links(a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray, large: np.ndarray) -> Iterator[tuple]:
    """Pairs of ids that share a group as (group, code, weight), in parts of about ``LINKS``; both sides in the order of groups."""
    a_group, a_ids, a_weight = _folded(a_group, a_ids, large)
    b_group, b_ids, b_weight = _folded(b_group, b_ids, large)
    n = len(large)
    first = np.searchsorted(b_group, np.arange(n + 1))
    partners = (first[1:] - first[:-1])[a_group]
    total = np.append(0, np.cumsum(partners))
    at = 0
    while at < len(a_ids):
        to = max(at + 1, int(np.searchsorted(total, total[at] + LINKS, "right")) - 1)
        many = partners[at:to]
        mine = np.repeat(np.arange(at, to), many)
        other = np.arange(len(mine)) - np.repeat(total[at:to] - total[at], many) + first[a_group[mine]]
        yield a_group[mine], a_ids[mine] << 32 | b_ids[other], a_weight[mine] * b_weight[other]
        at = to


def _pairs_of_docs(parts: Iterator[tuple], doc_of: np.ndarray) -> pd.DataFrame:
    """``doc, code, weight`` with one row for each pair of a document."""
    found = pd.DataFrame({"doc": [], "code": [], "weight": []}, dtype=np.int64)
    for group, code, weight in parts:
        part = pd.DataFrame({"doc": doc_of[group], "code": code, "weight": weight})
        found = pd.concat([found, part.groupby(["doc", "code"], sort=False, as_index=False).sum()])
    return found.groupby(["doc", "code"], as_index=False).sum()


def _align(ids: pa.Array, texts: pa.Array, a: Side, b: Side, labels: pa.Array, block: int) -> pa.RecordBatch:
    """A block's documents, its pairs of ids and how many of its documents hold each, as one row."""
    texts = texts.fill_null("")
    spaced = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type))
    expected = [x if len(x) > 1 else b"" for x in spaced.cast(pa.large_binary()).to_pylist()]
    a_ids, a_doc, a_length, a_same = _laid_out(a, [x if t else b"" for x, t in zip(a.encode(spaced), expected)], expected)
    b_ids, b_doc, b_length, b_same = _laid_out(b, [x if t else b"" for x, t in zip(b.encode(texts), expected)], expected)
    n, same = len(expected), a_same & b_same
    frames = []
    for doc, numbers, length, name in ((a_doc, a_ids, a_length, "a"), (b_doc, b_ids, b_length, "b")):
        kept = same[doc]
        doc, numbers, end = doc[kept], numbers[kept], np.cumsum(length[kept])
        # Both sides have the same bytes for each document, so one axis holds all documents one behind another.
        frames.append((pd.DataFrame({"doc": doc, "at": end - length[kept], "end": end, name: np.arange(len(doc))}), numbers))
    (a_frame, a_ids), (b_frame, b_ids) = frames
    pairs = overlaps(a_frame, b_frame)
    closing = pairs[pairs["end_a"] == pairs["end_b"]].sort_values("a")
    doc_of = closing["doc"].to_numpy(np.int64)
    a_group, b_group = _groups(a_frame, closing["a"].to_numpy()), _groups(b_frame, closing["b"].to_numpy())
    n_groups = len(closing)
    a_many, b_many = np.bincount(a_group, minlength=n_groups), np.bincount(b_group, minlength=n_groups)

    held = _pairs_of_docs(links(a_group, a_ids, b_group, b_ids, a_many * b_many >= FOLD), doc_of)
    codes, holders = np.unique(held["code"].to_numpy(np.int64), return_counts=True)
    rank = np.searchsorted(codes, held["code"].to_numpy(np.int64))

    a_place = np.arange(len(a_ids)) + np.append(0, np.cumsum(b_many))[a_group]
    b_place = np.arange(len(b_ids)) + np.cumsum(a_many)[b_group]
    written = np.empty(len(a_ids) + len(b_ids), np.int64)
    written[a_place], written[b_place] = a_ids, b_ids + 2 * a.size
    written[a_place[closing["a"].to_numpy()]] += a.size
    written[b_place[closing["b"].to_numpy()]] += b.size
    text = labels.take(pa.array(written))
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(written) + 1]
    data = memoryview(text.buffers()[2] or b"").cast("B")

    def per_doc(doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        counted = np.zeros(n, np.int64)
        np.add.at(counted, doc, 1 if weights is None else weights)
        return counted

    n_a, n_b = per_doc(a_frame["doc"].to_numpy()), per_doc(b_frame["doc"].to_numpy())
    bounds = offsets[np.append(0, np.cumsum(n_a + n_b))].tolist()
    digests = [hashlib.sha256(data[p : q - 1]).hexdigest() if q > p else "" for p, q in zip(bounds[:-1], bounds[1:])]
    values = {
        "block": block,
        "doc_id": ids,
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": per_doc(doc_of),
        "n_links": per_doc(doc_of, a_many * b_many),
        "groups_sha256": digests,
        "n_pairs": per_doc(held["doc"].to_numpy(np.int64)),
        "pairs": _packed(np.diff(rank, prepend=0)),
        "weights": _packed(held["weight"].to_numpy(np.int64)),
        "codes": codes,
        "holders": holders,
    }
    return pa.RecordBatch.from_arrays([_one_row(v) for v in values.values()], names=list(values))


def _one_row(value: int | bytes | list[str] | np.ndarray | pa.Array) -> pa.Array:
    if isinstance(value, (int, bytes)):
        return pa.array([value])
    value = pa.array(value, pa.string() if isinstance(value, list) else pa.int64())
    return pa.ListArray.from_arrays(pa.array([0, len(value)], pa.int32()), value)


def _packed(values: np.ndarray) -> bytes:
    """Numbers as bytes; most are small, so most of the eight bytes are zeros that shrink away."""
    plain = np.ascontiguousarray(values, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def align_blocks(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = BLOCK) -> DataFrame:
    """Blocks of documents with about ``size`` bytes of text: a row for each, as :func:`align` reads it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, labels = sides(a_path, b_path)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = 0
            while at < batch.num_rows:
                to = at + max(1, int(np.searchsorted(np.cumsum(lengths[at:]), size, "right")))
                part = batch.slice(at, to - at)
                yield _align(part.column(0), part.column(1), a, b, labels, block)
                at, block = to, block + 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _SCHEMA)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, size: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A encodes a space and the text, side B the text; special tokens in a text are plain text. A null or empty
    text, and one whose bytes a side does not give back, has no tokens: zeros and an empty digest. A pair's count is the
    number of rows whose links hold it; ``n_best`` counts the links whose count no other pair of their A id exceeds,
    ``count_sum`` adds up the counts of all links.

    Texts are aligned whole; a text longer than ``size`` bytes is a block of its own. Repeated rows and null ids are
    rows of their own. An empty table gives no rows. Other columns are ignored.
    """
    blocks = common.stored(align_blocks(docs, a_path, b_path, size), "aligned")
    pair = F.posexplode(F.arrays_zip("codes", "holders")).alias("at", "pair")
    pairs = blocks.select(F.col("block").alias("of"), pair).select("of", "at", F.col("pair.codes").alias("code"), F.col("pair.holders").alias("holders"))
    counts = common.stored(pairs.groupBy("code").agg(F.sum("holders").alias("count")), "pairs").withColumn("a", F.shiftright("code", 32))
    # At most one row for each entry of vocabulary A.
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    judged = counts.join(F.broadcast(best), "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    known = pairs.select("of", "at", "code").join(judged, "code").select("of", "at", "count", "best")

    def finish(held: pa.Table, known: pa.Table) -> pa.Table:
        place = known.column("at").to_numpy()
        count, is_best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place], is_best[place] = known.column("count").to_numpy(), known.column("best").to_numpy().astype(np.int64)
        row = {name: held.column(name)[0] for name in held.column_names}
        at = np.cumsum(_unpacked(row["pairs"].as_py()))
        weights = _unpacked(row["weights"].as_py())
        ends = np.append(0, np.cumsum(row["n_pairs"].values.to_numpy()))

        def per_doc(values: np.ndarray) -> np.ndarray:
            sums = np.append(0, np.cumsum(values))
            return sums[ends[1:]] - sums[ends[:-1]]

        return pa.table({
            "doc_id": row["doc_id"].values,
            **{name: row[name].values for name in _PER_DOC},
            "n_best": per_doc(weights * is_best[at]),
            "count_sum": per_doc(weights * count[at]),
            "groups_sha256": row["groups_sha256"].values,
        })

    kept = blocks.drop("codes", "holders").groupBy("block")
    return kept.cogroup(known.groupBy("of")).applyInArrow(finish, _OUT)
