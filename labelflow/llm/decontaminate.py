"""Benchmark decontamination: SimHash fingerprints of item-sized windows, found by a multi-index.

Words are runs of letters and digits in lower case, shingles are five of them. A window as long as
a benchmark item slides over the text; its 64-bit SimHash is looked up among those of the items. The
index cuts fingerprints into four blocks: if two differ in at most 19 bits, they differ in at most 4
in some block, and all block values so near are entered, so no fingerprint within the radius is
missed. A pair found counts if its shingles, weighted by how often they occur, agree by 0.8 or more
(sum of the smaller weights over sum of the larger).

Only windows that hold a shingle of an item are fingerprinted: any other window has similarity 0. The
index is made of the items that share a shingle with the texts at hand, so a pass over the documents can
take very many items. An item of fewer than five words is one shingle of its own length: it is found
where its words follow each other.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations, repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..settings import row_keyed, written
from .batches import free_name, nullable, slices, worker_state

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 19, 4
PASS_ITEMS, PASS_BYTES = 40_000, 8 << 20  # benchmark items that one pass over the documents takes
INDEX_ITEMS = 500  # items of one index


class Match(NamedTuple):
    item: int
    start_word: int
    n_words: int
    distance: int
    similarity: float


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-case runs of letters, marks and digits of each text; a list of one empty word if there are none."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.string()).fill_null("")), r"[^\p{L}\p{M}\p{N}]+", " ")
    return pc.split_pattern(pc.utf8_trim(plain, " "), " ")


def shingles(words: list[str]) -> np.ndarray:
    parts = zip(*(words[k:] for k in range(SHINGLE)))
    return np.fromiter((xxhash.xxh64_intdigest(p, 0) for p in map(" ".join, parts)), np.uint64)


def fingerprints(hashes: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """SimHash of the runs of ``count`` shingles from ``start`` on; a bit is 1 if set in over half."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = (sums[start + count] - sums[start]) * 2 > count[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


class MultiIndex:
    """All fingerprints within ``radius`` bits of a query, by blocks that are within ``radius // blocks``."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius, self.blocks, self.width = prints, radius, blocks, 64 // blocks
        near = [sum(1 << b for b in bits) for n in range(radius // blocks + 1) for bits in combinations(range(self.width), n)]
        keys = (self._keys(prints)[:, :, None] ^ np.array(near, np.int64)).reshape(-1)
        order = np.argsort(keys, kind="stable")
        self.owner = (order // (blocks * len(near))).astype(np.int32)
        self.first = np.searchsorted(keys[order], np.arange((blocks << self.width) + 1))

    def _keys(self, prints: np.ndarray) -> np.ndarray:
        block = np.arange(self.blocks, dtype=np.uint64) * np.uint64(self.width)
        values = (prints[:, None] >> block) & np.uint64((1 << self.width) - 1)
        return values.astype(np.int64) + (np.arange(self.blocks) << self.width)

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query index, entry index and distance of every pair within the radius."""
        keys = self._keys(queries).reshape(-1)
        sizes = self.first[keys + 1] - self.first[keys]
        query = np.repeat(np.arange(len(keys)) // self.blocks, sizes)
        place = np.arange(sizes.sum()) - np.repeat(sizes.cumsum() - sizes, sizes) + np.repeat(self.first[keys], sizes)
        pairs = np.unique(query * max(1, len(self.prints)) + self.owner[place])
        query, entry = np.divmod(pairs, max(1, len(self.prints)))
        distance = np.bitwise_count(queries[query] ^ self.prints[entry]).astype(np.int64)
        good = distance <= self.radius
        return query[good], entry[good], distance[good]


def _keys(codes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """A number for each ``size`` words known to the items; equal numbers for others only make more windows."""
    n = max(0, len(codes) - size + 1)
    key = np.zeros(n, np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n].astype(np.uint64)
    return key


class Items:
    """The benchmark items of one pass, prepared for the search."""

    def __init__(self, texts: list[str | None], similarity: float = SIMILARITY):
        self.similarity = similarity
        words = [w if w[0] else [] for w in words_of(pa.array(texts, pa.string())).to_pylist()]
        self.size = np.array([len(w) for w in words], np.int64)
        self.hashes = [shingles(w) for w in words]
        whole = np.array([0])
        prints = [fingerprints(h, whole, whole + len(h))[0] if len(h) else np.uint64(0) for h in self.hashes]
        self.prints = np.array(prints, np.uint64)
        self.words = pc.unique(pa.array([w for ws in words for w in ws], pa.string()))
        flat = pc.index_in(pa.array([w for ws in words for w in ws], pa.string()), self.words).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(self.size)
        codes = [flat[e - n:e] for e, n in zip(ends.tolist(), self.size.tolist())]
        keys = np.concatenate([_keys(c) for c in codes] or [np.empty(0, np.uint64)])
        owner = np.repeat(np.arange(len(words)), [max(0, len(c) - SHINGLE + 1) for c in codes])
        order = np.argsort(keys, kind="stable")
        self.keys, self.owner = keys[order], owner[order]
        self.short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # by length: keys in order, their items and codes
        for n in range(1, SHINGLE):
            own = np.flatnonzero(self.size == n)
            if len(own):
                rows = np.stack([codes[i] for i in own])
                key = np.concatenate([_keys(row, n) for row in rows])
                order = np.argsort(key, kind="stable")
                self.short[n] = key[order], own[order], rows[order]
        self.members = np.empty(0, np.int64)  # the items of the index, in order
        self.index = MultiIndex(np.empty(0, np.uint64))
        self.weights: dict[int, Counter] = {}

    def _use(self, items: np.ndarray) -> None:
        """Have an index that holds at least the given items (in order, ``INDEX_ITEMS`` at most)."""
        if not np.isin(items, self.members).all():
            both = np.union1d(items, self.members)
            self.members = both if len(both) <= INDEX_ITEMS else items
            self.index = MultiIndex(self.prints[self.members])
            self.weights = {i: Counter(self.hashes[i].tolist()) for i in self.members.tolist()}

    def search(self, texts: pa.Array) -> list[list[Match]]:
        """The items that each text holds, by item: the nearest window that passes, the first of equals."""
        lists = words_of(texts)
        words, ends = lists.flatten(), lists.offsets.to_numpy()
        ends = ends - ends[0]
        found: list[list[Match]] = [[] for _ in range(len(lists))]
        if not len(self.words):
            return found
        codes = pc.index_in(words, self.words).fill_null(-1).to_numpy().astype(np.int64)
        for size in self.short:
            for t, match in self._short(codes, ends, size):
                found[t].append(match)
        at = self._known(codes, ends, SHINGLE)
        key = _at(codes, at, SHINGLE)
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        at, low, high = (x[high > low] for x in (at, low, high))
        if len(at):
            times = high - low
            item = self.owner[np.arange(times.sum()) - np.repeat(times.cumsum() - times, times) + np.repeat(low, times)]
            anchor = np.repeat(at, times)
            asked = np.unique(item)
            for k in range(0, len(asked), INDEX_ITEMS):
                some = asked[k:k + INDEX_ITEMS]
                self._use(some)
                mine = (item >= some[0]) & (item <= some[-1])
                text = np.searchsorted(ends, anchor[mine], "right") - 1
                for first, last in _runs(text):
                    t = int(text[first])
                    begin, end = int(ends[t]), int(ends[t + 1])
                    found[t] += self._match(words.slice(begin, end - begin), anchor[mine][first:last] - begin, item[mine][first:last], some)
        return [sorted(f) for f in found]

    @staticmethod
    def _known(codes: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        """Places where so many words of one text are known to the items."""
        n = max(0, len(codes) - size + 1)
        known = np.ones(n, bool)
        for k in range(size):
            known &= codes[k:k + n] >= 0
        at = np.flatnonzero(known)
        return at[np.searchsorted(ends, at, "right") == np.searchsorted(ends, at + size - 1, "right")]

    def _short(self, codes: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, Match]]:
        """Text and match of the items of ``size`` words, where they stand first in a text."""
        keys, items, rows = self.short[size]
        at = self._known(codes, ends, size)
        key = _at(codes, at, size)
        low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
        times = high - low
        place = np.arange(times.sum()) - np.repeat(times.cumsum() - times, times) + np.repeat(low, times)
        at = np.repeat(at, times)
        same = np.ones(len(at), bool)
        for k in range(size):
            same &= codes[at + k] == rows[place, k]
        at, item = at[same], items[place[same]]
        text = np.searchsorted(ends, at, "right") - 1
        _, first = np.unique(text * len(self.size) + item, return_index=True)
        for i in first.tolist():
            yield int(text[i]), Match(int(item[i]), int(at[i] - ends[text[i]]), size, 0, 1.0)

    def _match(self, words: pa.Array, anchors: np.ndarray, items: np.ndarray, asked: np.ndarray) -> list[Match]:
        """``anchors``: places of shingles that the ``items`` beside them hold, all ``asked`` for now."""
        n = len(words)
        windows = set()  # start and length; a text shorter than the item is one window
        for item in np.unique(items):
            size = min(int(self.size[item]), n)
            places = np.unique(anchors[items == item])
            starts = (places[:, None] - np.arange(size - SHINGLE + 1)).ravel()
            windows.update(zip(np.unique(starts[(starts >= 0) & (starts <= n - size)]).tolist(), repeat(size)))
        ordered = np.array(sorted(windows), np.int64)
        best: dict[int, Match] = {}
        for a, b in _stretches(ordered):
            start, size = ordered[a:b, 0], ordered[a:b, 1]
            origin = int(start.min())
            hashes = shingles(words.slice(origin, int((start + size).max()) - origin).to_pylist())
            prints = fingerprints(hashes, start - origin, size - SHINGLE + 1)
            query, entry, distance = self.index.within(prints)
            entry = self.members[entry]
            fits = (self.size[entry] == size[query]) | ((size[query] == n) & (self.size[entry] > n))
            fits &= np.isin(entry, asked)
            for q, e, d in sorted(zip(query[fits].tolist(), entry[fits].tolist(), distance[fits].tolist()), key=lambda x: (x[1], x[2], x[0])):
                if e in best and best[e].distance <= d:
                    continue
                s, k = int(start[q]), int(size[q])
                agreed = self._similarity(hashes[s - origin:s - origin + k - SHINGLE + 1], e)
                if agreed >= self.similarity:
                    best[e] = Match(e, s, k, d, agreed)
        return [best[e] for e in sorted(best)]

    def _similarity(self, hashes: np.ndarray, item: int) -> float:
        here, there = Counter(hashes.tolist()), self.weights[item]
        shared = sum(min(w, there[h]) for h, w in here.items() if h in there)
        return shared / max(1, len(hashes) + len(self.hashes[item]) - shared)


def _at(codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The numbers of ``_keys`` at some places."""
    key = np.zeros(len(at), np.uint64)
    for k in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + codes[at + k].astype(np.uint64)
    return key


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of each run of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    edges = [0, *cuts.tolist(), len(values)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if b > a]


def _stretches(windows: np.ndarray, most: int = 4096) -> Iterator[tuple[int, int]]:
    """Runs of windows, sorted by start, that overlap; a run is cut when it gets long, to bound its memory."""
    begin, reach = 0, -1
    for i, (start, size) in enumerate(windows.tolist()):
        if i > begin and (start > reach or i - begin >= most):
            yield begin, i
            begin, reach = i, -1
        reach = max(reach, start + size)
    if len(windows):
        yield begin, len(windows)


def _passes(benchmark: DataFrame, item_id: str, item_text: str, before: Callable[[], None] = lambda: None) -> Iterator[tuple[list, list]]:
    """The items in runs of bounded number and size, each to be held by every task of one pass. ``before`` is
    called between two passes."""
    items = benchmark.select(F.col(f"`{item_id}`").alias("item"), F.col(f"`{item_text}`").cast("string").alias("text"))
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    passes = max(1, math.ceil(n / PASS_ITEMS), math.ceil(size / PASS_BYTES)) if n else 0
    for b in range(passes):
        if b:
            before()
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == b).orderBy("item", "text").collect()
        names, texts = [r["item"] for r in rows], [r["text"] for r in rows]
        del rows
        yield names, texts
        del names, texts


def _prepared(texts: list[str | None], similarity: float) -> Items:
    """The items, kept by a worker for its later tasks."""
    key = xxhash.xxh128_intdigest("\0".join("\1" if t is None else t for t in texts).encode())
    return worker_state(("items", key, similarity), lambda: Items(texts, similarity))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", similarity: float = SIMILARITY,
) -> DataFrame:
    """A row per document and item it holds: both ids, ``start_word, n_words, distance, similarity`` of
    the nearest window that passes. The documents are read once for every ``PASS_ITEMS`` items (or
    ``PASS_BYTES`` of their texts); the rows of each pass but the last are written before the next one
    is collected, so the driver and the plan hold one.

    An item of one to four words is found wherever these words follow each other, so a benchmark of single common
    words matches much. Null and empty texts and items match nothing; repeated rows of either table give
    repeated rows; an empty table gives an empty result. Texts may be of any length.
    """
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    kinds = [ids.schema["doc"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()]
    schema = f"doc {kinds[0]}, item {kinds[1]}, start_word bigint, n_words bigint, distance bigint, similarity double"
    item_kind = to_arrow_type(benchmark.schema[item_id].dataType)
    parts = []
    for names, texts in _passes(benchmark, item_id, item_text, before=lambda: parts.append(written(parts.pop(), "matches"))):

        def run(batches: Iterator[pa.RecordBatch], names=names, texts=texts) -> Iterator[pa.RecordBatch]:
            items = _prepared(texts, similarity)
            labels = pa.array(names, item_kind)
            for batch in batches:
                for b in slices(batch, 1):
                    found = [(row, m) for row, matches in enumerate(items.search(b.column(1))) for m in matches]
                    if found:
                        yield pa.RecordBatch.from_arrays([
                            b.column(0).take(pa.array([row for row, _ in found])), labels.take(pa.array([m.item for _, m in found])),
                            *(pa.array([m[k] for _, m in found]) for k in (1, 2, 3, 4))],
                            ["doc", "item", "start_word", "n_words", "distance", "similarity"])

        parts.append(ids.mapInArrow(run, schema))
        del names, texts, run  # nor does this frame hold them while the next pass is collected
    out = reduce(DataFrame.unionByName, parts or [docs.sparkSession.createDataFrame([], schema)])
    return out.withColumnsRenamed({"doc": doc_id, "item": item_id})


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with all their columns. If the benchmark is one pass, each row
    is judged where it is read, without a shuffle. For a larger one the rows are numbered and written once,
    whatever the number of passes; a pass writes the numbers of the rows it finds, and they are taken out at the end.
    """
    size = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(f"`{item_text}`").cast("string"))), F.lit(0))).first()
    if size[0] <= PASS_ITEMS and size[1] <= PASS_BYTES:
        at = docs.columns.index(text)
        for _, texts in _passes(benchmark, item_id, item_text):

            def run(batches: Iterator[pa.RecordBatch], texts=texts) -> Iterator[pa.RecordBatch]:
                items = _prepared(texts, similarity)
                for batch in batches:
                    for b in slices(batch, at):
                        yield b.filter(pa.array([not m for m in items.search(b.column(at))], pa.bool_()))

            docs = docs.mapInArrow(run, nullable(docs.schema))
        return docs
    row = free_name("_row", docs.columns)
    numbered = row_keyed(docs, row)
    found = contaminated(numbered, benchmark, row, text, item_id, item_text, similarity)
    return numbered.join(found.select(row).distinct(), row, "left_anti").drop(row)
