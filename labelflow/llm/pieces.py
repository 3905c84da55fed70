"""Encoding and decoding with merge-type SentencePiece vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by score. A text is first cut where no
piece of the vocabulary has the two neighbouring characters next to each other: nothing can be
merged over such a seam, so the parts are encoded on their own and remembered. The library
normalises and decodes, and every distinct word of an Arrow batch that a worker does not remember is
encoded by it as well and compared.
"""

from __future__ import annotations

import re
from array import array
from heapq import heapify, heappop, heappush
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .batches import RUN, Memo, map_text, worker_state

SPACE = "▁"  # stands for a blank in pieces
WORDS = 400_000  # words that a worker remembers, and half as many parts of cut words, twice at most


class Pieces:
    """One vocabulary with what has been encoded by it."""

    def __init__(self, path: str, words: int = WORDS):
        import sentencepiece

        lib = self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(lib.vocab_size())
        if any(lib.is_unused(i) for i in every) or lib.normalize("a") != SPACE + "a":
            raise ValueError("only vocabularies without unused pieces and with a leading blank are supported")
        plain = [i for i in every if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))]
        byte = {int(lib.id_to_piece(i)[3:5], 16): i for i in every if lib.is_byte(i)}
        if len(byte) < 256:
            raise ValueError("only vocabularies with a piece for each byte are supported")
        self.ids = {lib.id_to_piece(i): i for i in plain}
        if wrong := next((p for p in self.ids if SPACE in p.lstrip(SPACE)), None):
            raise ValueError(f"only vocabularies whose pieces cross no blank are supported, not with {wrong!r}")
        self.byte = byte
        self.cost = {lib.id_to_piece(i): -lib.get_score(i) for i in plain}
        self.inside = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.begin, self.end = (array("I", [i]).tobytes() for i in (lib.bos_id(), lib.eos_id()))
        self.part = Memo(self._part, words // 2)
        self.word = Memo(self._word, words)
        self.fresh: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Merge the best scored adjacent pair, the leftmost of equals, until no pair is a piece."""
        cost, symbol, n = self.cost.get, list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(c, i, 2) for i, c in enumerate(map(cost, map(add, symbol, symbol[1:]))) if c is not None]
        heapify(agenda)
        while agenda:
            _, i, size = heappop(agenda)
            left, j = symbol[i], after[i]
            if not left or j >= n or len(left) + len(symbol[j]) != size:
                continue  # one of the two has been merged since; symbols only grow
            both = symbol[i] = left + symbol[j]
            symbol[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (c := cost(both + symbol[k])) is not None:
                    heappush(agenda, (c, i, size + len(symbol[k])))
            h = before[i]
            if h >= 0 and (c := cost(symbol[h] + both)) is not None:
                heappush(agenda, (c, h, len(symbol[h]) + size))
        return [s for s in symbol if s]

    def _part(self, text: str) -> bytes:
        symbols = self.merge(text)
        ids = [self.ids.get(s) for s in symbols]
        if None in ids:
            ids = [i for s, known in zip(symbols, ids) for i in ([self.byte[b] for b in s.encode()] if known is None else [known])]
        return array("I", ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a blank and ``word``, a run of blanks with what follows it."""
        text = SPACE + word
        seams = [i for i, pair in enumerate(map(add, text, word), 1) if pair not in self.inside]
        if seams:
            ids = b"".join([self.part[text[a:b]] for a, b in zip([0, *seams], [*seams, len(text)])])
        else:
            ids = self._part(text)  # the word itself is remembered, so its only part needs no room of its own
        self.fresh[word] = ids
        return ids

    def _words(self, text: str) -> list[str]:
        """The words of a normalised text, each without the blank before it."""
        return [w[1:] for w in re.findall(f"{SPACE}+[^{SPACE}]*", text)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text between the begin and the end id, and the
        ends of the texts. Every distinct word of the texts is looked up once."""
        plain = pa.array(self.library.normalize(texts), pa.string())
        lists = pc.split_pattern(plain, SPACE)  # a text begins with a blank, so the first item is empty
        runs = pc.or_(pc.match_substring(plain, SPACE * 2), pc.ends_with(plain, SPACE)).to_numpy(zero_copy_only=False)
        if runs.any():
            lists = pa.array([["", *self._words(t)] if odd else t.split(SPACE) for t, odd in zip(plain.to_pylist(), runs)], pa.list_(pa.string()))
        starts = lists.offsets.to_numpy()[:-1]
        words = lists.flatten().dictionary_encode()
        known = [self.word[w] for w in words.dictionary.to_pylist()]
        code = words.indices.to_numpy().copy()
        code[starts] = len(known)  # in place of the empty first item: the begin id, and the end id of the text before
        edge = np.frombuffer(self.end + self.begin, "<u4")
        table = np.concatenate([np.frombuffer(b"".join(known), "<u4"), edge])
        size = np.array([*(len(k) // 4 for k in known), 2], np.int64)
        count = size[code]
        ends = np.cumsum(count)
        first = np.repeat(((np.cumsum(size) - size)[code] - (ends - count)).astype(np.int32), count)
        ids = table[first + np.arange(len(first), dtype=np.int32)]
        # the first text has no text before it, the last one lacks its end id
        return np.append(ids[1:], edge[:1]), np.append(ends[starts[1:] - 1], len(ids))

    def check(self) -> None:
        """Compare with the library every word that has been encoded since the last check: all words of the texts
        but those that are still remembered from an earlier one. (A last blank by itself can't be compared: the
        library adds a blank to a text, and none to the empty one.)"""
        words = [w for w in self.fresh if w]
        theirs = self.library.encode([w.replace(SPACE, " ") for w in words])
        if array("I", chain.from_iterable(theirs)).tobytes() != b"".join(map(self.fresh.__getitem__, words)):
            wrong = next(w for w, ids in zip(words, theirs) if array("I", ids).tobytes() != self.fresh[w])
            raise ValueError(f"other ids than the library's for {wrong!r}")
        self.fresh = {}


def encode(df: DataFrame, path: str, text: str = "text", words: int = WORDS, run: int = RUN) -> DataFrame:
    """The columns of ``df`` but ``text``, with ``ids`` (binary: little-endian unsigned 32-bit ids
    between the begin and the end id) and ``decoded`` (the library's text for them).

    Columns of these names are replaced. Null counts as the empty text, whose ids are begin and end.
    Rows keep their number and repeated rows get equal results; an empty table gives an empty one.
    A worker remembers about ``words`` words and takes up texts of about ``run`` bytes at once: fewer
    take less memory and more time, and change no result.
    """

    def start():
        model = worker_state(("pieces", path, words), lambda: Pieces(path, words))

        def make(texts: pa.Array) -> list[pa.Array]:
            ids, ends = model.encode([t or "" for t in texts.to_pylist()])
            model.check()
            bounds = np.concatenate([[0], ends])
            decoded = [model.library.decode(ids[a:b].tolist()) for a, b in zip(bounds, ends)]
            binary = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids)])
            return [binary, pa.array(decoded, pa.string())]

        return make

    return map_text(df, text, {"ids": "binary", "decoded": "string"}, start, run)
