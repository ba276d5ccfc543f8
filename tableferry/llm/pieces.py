"""SentencePiece encoding and decoding by a Viterbi pass over a trie of marked words.

A text is a sequence of marked words (the mark stands for the blank before a word), and no piece joins other characters
with a mark after them, so words are encoded apart. The distinct words of a batch are sorted, which is the depth-first
order of their trie, and encoded in that order: the forward scores of a word's prefixes are kept for as long as the
next words share them.

The public vocabulary holds the pieces of a merging model (byte-pair encoding), whose scores are ranks of merges. The
greatest sum of ranks is not what such a model encodes, so a transition of the lattice is admitted only between two
pieces that merging leaves apart; on admitted paths the ids are those of the library.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.vocabulary import Vocabulary

#: Fixed value: the mark that stands for a blank.
MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
#: Pairs of pieces whose merging is remembered.
PAIRS = 2_000_000


class Lattice:
    """The pieces of a model and the admitted transitions between them."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes_at = next(i for i in range(size) if model.is_byte(i))
        plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.number = {names[i]: i for i in plain}
        self.names = names
        self.score = [model.get_score(i) for i in range(size)]
        self.longest = max(map(len, self.number))
        self.text = [b""] * size  # what each id decodes to
        for i in plain:
            self.text[i] = names[i].replace(MARK, " ").encode()
        for b in range(256):
            self.text[self.bytes_at + b] = bytes([b])
        self._apart: dict[int, bool] = {}

    def merged(self, text: str) -> list[str]:
        """Merges of one short text: the pair of the best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.number.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.score[found] > best):
                    best, at = self.score[found], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """Whether merging leaves two neighbouring pieces as they are."""
        key = left << 20 | right
        found = self._apart.get(key)
        if found is None:
            if len(self._apart) > PAIRS:
                self._apart.clear()
            a, b = self.names[left], self.names[right]
            found = self._apart[key] = self.merged(a + b) == [a, b]
        return found

    def whole(self, piece: int) -> bool:
        """Whether merging arrives at a piece at all."""
        key = -1 - piece
        found = self._apart.get(key)
        if found is None:
            found = self._apart[key] = self.merged(self.names[piece]) == [self.names[piece]]
        return found

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of sorted words. ``piece[i]``, ``begin[i]`` and ``total[i]`` describe the best path to prefix ``i``."""
        piece, begin, total = [-1], [0], [0.0]
        out, before = [], ""
        for word in words:
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del piece[shared + 1 :], begin[shared + 1 :], total[shared + 1 :]
            for i in range(shared + 1, len(word) + 1):
                self._step(word, i, piece, begin, total)
            ids, at = [], len(word)
            while at:
                start = begin[at]
                if piece[at] < 0:
                    ids += [self.bytes_at + b for b in reversed(word[start:at].encode("utf-8", "surrogatepass"))]
                else:
                    ids.append(piece[at])
                at = start
            ids.reverse()
            out.append(ids)
            before = word
        return out

    def _step(self, word: str, i: int, piece: list[int], begin: list[int], total: list[float]) -> None:
        best = None
        for start in range(max(0, i - self.longest), i):
            number = self.number.get(word[start:i])
            if number is None:
                continue
            last = piece[start]
            if (self.apart(last, number) if start and last >= 0 else self.whole(number)) and (best is None or total[start] + self.score[number] > best):
                best = total[start] + self.score[number]
                chosen = number, start
        if best is None:  # a character without a piece becomes bytes, and nothing merges with it
            chosen, best = (-1, i - 1), total[i - 1]
        piece.append(chosen[0])
        begin.append(chosen[1])
        total.append(best)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        words = _WORD.findall(MARK + text.replace(" ", MARK)) if text else []
        order = sorted(set(words))
        found = dict(zip(order, self.encode_sorted(order)))
        return [i for word in words for i in found[word]]

    def decode(self, ids: np.ndarray) -> bytes:
        text = b"".join(map(self.text.__getitem__, ids.tolist()))
        return text[1:] if text.startswith(b" ") else text


_OPEN: dict[str, tuple[Lattice, Vocabulary]] = {}


def opened(path: str | None = None) -> tuple[Lattice, Vocabulary]:
    """The lattice of a model file and its cached encoder; one for each worker."""
    import public_tokenizers

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    if path not in _OPEN:
        lattice = Lattice(path)

        def many(parts: list[str]) -> list[bytes]:
            order = sorted(range(len(parts)), key=parts.__getitem__)
            out = [b""] * len(parts)
            for i, ids in zip(order, lattice.encode_sorted([MARK + parts[i] for i in order])):
                out[i] = np.asarray(ids, "<u4").tobytes()
            return out

        _OPEN[path] = lattice, Vocabulary(lattice.encode, many, False, chunk=1 << 30)
    return _OPEN[path]


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids`` of each row: the ids of the whole text. A null text has none, as an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = opened(path)[1]
        for batch in batches:
            if batch.num_rows:
                packed = vocabulary.encode(batch.column(1))
                values = pa.array(np.frombuffer(b"".join(packed), "<u4").astype(np.int32))
                ends = pa.array(np.append(0, np.cumsum([len(x) // 4 for x in packed])).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, values)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, text`` of each row of ids; bytes that are no UTF-8 are replaced; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = opened(path)[0]
        for batch in batches:
            if batch.num_rows:
                texts = [lattice.decode(np.asarray(x or [], np.int64)).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


_DIGEST = "doc_id long, n_tokens long, n_byte_tokens long, ids_crc32 long, decoded_crc32 long, round_trip boolean"


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row for each row of ``docs``: digests of the ids of the whole text and of what they decode to.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids, ``decoded_crc32`` over the UTF-8 text; ``round_trip``
    tells whether the text came back. A null text counts as empty. Repeated rows and null ids stay; an empty table
    gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, vocabulary = opened(path)
        for batch in batches:
            rows = []
            for doc, text, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), vocabulary.encode(batch.column(1))):
                ids = np.frombuffer(packed, "<u4")
                back = lattice.decode(ids)
                single = np.count_nonzero((ids >= lattice.bytes_at) & (ids < lattice.bytes_at + 256))
                rows.append((doc, len(ids), single, zlib.crc32(packed), zlib.crc32(back), back == (text or "").encode("utf-8", "surrogatepass")))
            if rows:
                kinds = [pa.int64()] * 5 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in _DIGEST.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _DIGEST)
