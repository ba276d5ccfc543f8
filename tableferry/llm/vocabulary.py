"""Token ids of whole texts by public vocabularies, through a bounded cache of words.

A byte-level vocabulary splits a text before every blank that is followed by no white space, and a piece vocabulary
never joins other characters with a blank after them. So a text is the sequence of its blank-separated parts, each of
which is encoded by the library once for as long as it stays in the cache. A text with other white space after a
blank, or two blanks together, is encoded as a whole.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Parts that one Python worker keeps. They stand in two halves: when the younger is full it becomes the older, and
#: what is asked for again moves to the younger.
CACHE = 500_000
_CHUNK = 200
_ROWS = 2_000


def _packed(ids: Iterable[int]) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _regular(part: str) -> bool:
    return part != "" and not part[0].isspace() and part[0] != "▁" and part[-1] != "▁"


class Vocabulary:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, whole: Callable[[str], list[int]], many: Callable[[list[str]], list[bytes]], inner: bool, chunk: int = _CHUNK):
        """``whole`` encodes a text, ``many`` regular parts as they stand behind a blank.

        ``inner``: such a part differs from one that begins a text; ``chunk``: parts given to ``many`` at once.
        """
        self._whole, self._many, self._apart, self._chunk = whole, many, inner, chunk
        self._parts: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of an Arrow string array; a null text has none."""
        out: list[bytes] = []
        for start in range(0, len(texts), _ROWS):
            out += self._encode(texts.take(pa.array(range(start, min(len(texts), start + _ROWS)), pa.int64())).fill_null(""))
        return out

    def _known(self, parts: list[str]) -> list[bytes | None]:
        if len(self._parts) > CACHE // 2:
            self._parts, self._older = {}, self._parts
        found = list(map(self._parts.get, parts))
        new: dict[str, bytes] = {}
        order = []
        for part, ids in zip(parts, found):
            if ids is None:
                ids = self._older.get(part)
                if ids is not None:
                    new[part] = ids
                elif _regular(part):
                    order.append(part)
        for start in range(0, len(order), self._chunk):
            chunk = order[start : start + self._chunk]
            new.update(zip(chunk, self._many(chunk)))
        self._parts.update(new)
        return [new.get(p) if ids is None else ids for p, ids in zip(parts, found)]

    def _encode(self, texts: pa.Array) -> list[bytes]:
        lists = pc.split_pattern(texts.cast(pa.large_string()), " ")
        starts = lists.offsets.to_numpy()
        coded = lists.values.dictionary_encode()
        known = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.array([x or b"" for x in known], pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        data = memoryview(ids.buffers()[2] or b"")
        odd = np.array([x is None for x in known], bool)[coded.indices.to_numpy()]
        if self._apart:
            odd[starts[:-1]] = False
        irregular = np.append(0, np.cumsum(odd))[starts]
        out = []
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
            if irregular[i] != irregular[i + 1]:
                text = texts[i].as_py()
                out.append(_packed(self._whole(text)) if text else b"")
            elif self._apart:
                head = lists.values[a].as_py()
                out.append((_packed(self._whole(head)) if head else b"") + bytes(data[ends[a + 1] : ends[b]]))
            else:
                out.append(bytes(data[ends[a] : ends[b]]))
        return out


#: The vocabulary that a worker uses; another one takes its place, with its cache.
_OPEN: dict[str, Vocabulary] = {}


def byte_bpe(path: str | None = None) -> Vocabulary:
    """The byte-level vocabulary of the ``tokenizers`` library; one for each worker."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.json")
    if path not in _OPEN:
        _OPEN.clear()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.encode_special_tokens = True
        widths = np.zeros(model.get_vocab_size(), np.int64)  # a token's text has one character for each byte
        for token, number in model.get_vocab().items():
            widths[number] = len(token)

        def whole(text: str) -> list[int]:
            return model.encode_batch_fast([text], add_special_tokens=False)[0].ids

        def many(parts: list[str]) -> list[bytes]:
            ids = np.asarray(whole(" " + " ".join(parts)), "<u4")
            ends = np.cumsum([len(x.encode("utf-8", "surrogatepass")) + 1 for x in parts])
            cuts = np.searchsorted(np.cumsum(widths[ids]), ends) + 1
            return [ids[a:b].tobytes() for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

        _OPEN[path] = Vocabulary(whole, many, True)
    return _OPEN[path]


def piece_bpe(path: str | None = None) -> Vocabulary:
    """The piece vocabulary with byte fallback of the ``sentencepiece`` library; one for each worker."""
    import public_tokenizers

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    if path not in _OPEN:
        _OPEN.clear()
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)

        def many(parts: list[str]) -> list[bytes]:
            return [_packed(x) for x in model.encode(parts, num_threads=1)]

        _OPEN[path] = Vocabulary(model.encode, many, False)
    return _OPEN[path]
