"""Ranked lexical search: exact inner products over sparse ball trees.

A document is the sparse vector of ``w * saturation(tf)`` over the terms of the items, an item the set
of its terms; the score is their inner product, all whole numbers.

1. One pass over the documents keeps their length and the counts of the items' terms. Document counts
   and totals are taken from that table.
2. The documents that a task reads become ball trees, some thousands of documents each. A ball has
   a centroid ``c`` and radii: ``q.y <= q.c + |q| r``, with one radius for all terms and with one
   for each block of terms (rare terms of an item share a block, so a ball without them is seen to be).
   Bounds are computed in doubles and widened by more than their rounding error.
3. Every item walks a tree best-first and stops at the first bound below its ``k``-th score. Leaves
   are scored in whole numbers.
4. A sample of the documents is searched first: its ``k``-th score of an item is a lower limit for all
   trees, so that most of them return nothing.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import measure, written
from .batches import chunks, slices, utf8

TOP = 50  # fixed by the contract, as are the numbers in ``weights`` and ``saturated``
SHARD_DOCS = 8192  # documents of a tree
SHARD_TERMS = 1 << 21  # and their terms, about
LEAF = 32
BLOCKS = 64  # of terms, each with a radius of its own
ITEMS_AT_ONCE = 500  # items that one tree is built for
ITEM_BYTES = 32 << 20  # text of the items of one pass over the documents
SAMPLE = 16_384  # documents that the lower limits come from
SAFE = 1e-9  # relative; sums of some million terms in doubles are good to 1e-10

# separators become blanks, A-Z lower case; bytes of other characters stay
_FOLD = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text, with repeats."""
    return text.translate(_FOLD).split()


@dataclass
class Items:
    """The distinct terms of each item as numbers, and the dictionary that numbers them by their first item."""

    ids: list
    terms: list[np.ndarray]
    owner: np.ndarray  # the first item that has a term
    index: dict[bytes, int]

    @classmethod
    def of(cls, rows: list[tuple]) -> Items:
        index: dict[bytes, int] = {}
        owner: list[int] = []
        found = []
        for k, (_, text) in enumerate(rows):
            own = sorted(set(terms((text or "").encode())))
            for t in own:
                if index.setdefault(t, len(index)) == len(owner):
                    owner.append(k)
            found.append(np.array([index[t] for t in own], np.int64))
        return cls([i for i, _ in rows], found, np.array(owner, np.int64), index)


def count_terms(docs: DataFrame, doc_id: str, text: str, index: dict[bytes, int]) -> DataFrame:
    """``doc``, ``n`` (terms of the document), and the numbers and counts of its terms in ``index``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 1):
                n, found, counts, ends = [], [], [], [0]
                for body in utf8(b.column(1)):
                    total, held = 0, Counter()
                    for piece in chunks(body):
                        words = terms(piece)
                        total += len(words)
                        held.update(filter(index.__contains__, words))
                    pairs = sorted((index[t], c) for t, c in held.items())
                    n.append(total)
                    found += [t for t, _ in pairs]
                    counts += [c for _, c in pairs]
                    ends.append(len(found))
                cuts = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(cuts, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(cuts, pa.array(counts, pa.int64()))], ["doc", "n", "terms", "tf"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc bigint, n bigint, terms array<int>, tf array<bigint>")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def saturated(tf: np.ndarray, lengths: np.ndarray, rows: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The part of a term's score that its count gives, less for long documents."""
    m = np.array([100 - 50 + (50 * n * n_docs) // n_terms for n in lengths.tolist()], np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m[rows])


class Rows:
    """Sparse rows: of row ``i`` the columns and values from ``start[i]`` to ``start[i + 1]``; none is empty."""

    def __init__(self, start: np.ndarray, cols: np.ndarray, vals: np.ndarray):
        self.start, self.cols, self.vals = start, cols, vals

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[:-1][rows] - start[:-1], size) + np.arange(start[-1])
        return Rows(start, self.cols[at], self.vals[at])

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.start[:-1])

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.start))


class BallTree:
    """Balls over sparse rows of whole numbers of at least zero. Node 0 is the root; node ``i`` has the rows
    ``order[first[i]:last[i]]`` and the children ``child[i]`` and the one after, or none (0)."""

    def __init__(self, rows: Rows, width: int, block: np.ndarray, blocks: int, leaf: int = LEAF):
        self.order = np.arange(len(rows))
        self.first, self.last, self.child = [0], [len(rows)], [0]
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.block_radius: list[np.ndarray] = []
        node = 0
        while node < len(self.first):
            a, b = self.first[node], self.last[node]
            own = rows.take(self.order[a:b])
            far = self._ball(own, width, block, blocks)
            if b - a > leaf:
                side = self._side(own, width, far)
                self.order[a:b] = self.order[a:b][np.argsort(side, kind="stable")]
                self.child[node] = len(self.first)
                self.first += [a, (a + b) // 2]
                self.last += [(a + b) // 2, b]
                self.child += [0, 0]
            node += 1
        self.rows = rows.take(self.order)

    def _ball(self, own: Rows, width: int, block: np.ndarray, blocks: int) -> int:
        """Add centroid and radii of the rows; returns the row farthest from the centroid."""
        vals = own.vals.astype(np.float64)
        centre = np.bincount(own.cols, vals, width) / len(own)
        # |y - c|^2 by block: |c|^2, and for the terms of the row (y - c)^2 - c^2
        base = np.bincount(block, centre * centre, blocks)
        at = centre[own.cols]
        part = np.bincount(own.row_of() * blocks + block[own.cols], vals * (vals - 2 * at), len(own) * blocks).reshape(len(own), blocks)
        size = np.bincount(own.row_of() * blocks + block[own.cols], vals * vals, len(own) * blocks).reshape(len(own), blocks)
        square = np.maximum(part + base, 0) + SAFE * (size + base)  # the difference of nearly equal sums is widened by their size
        whole = square.sum(axis=1)
        self.centre.append(centre)
        self.radius.append(math.sqrt(whole.max()))
        self.block_radius.append(np.sqrt(square.max(axis=0)))
        return int(whole.argmax())

    @staticmethod
    def _side(own: Rows, width: int, far: int) -> np.ndarray:
        """The place of each row between two far rows: the halves are cut there."""
        vals = own.vals.astype(np.float64)

        def dense(row: int) -> np.ndarray:
            out = np.zeros(width)
            out[own.cols[own.start[row]:own.start[row + 1]]] = vals[own.start[row]:own.start[row + 1]]
            return out

        one = dense(far)
        distance = own.sums(vals * (vals - 2 * one[own.cols]))
        other = dense(int(distance.argmax()))
        return own.sums(vals * (other - one)[own.cols])

    def bounds(self, terms: list[np.ndarray], block: np.ndarray) -> np.ndarray:
        """For each node and item (its terms, not none) no less than the largest inner product of the node's rows."""
        start = np.cumsum([0, *(len(t) for t in terms)])[:-1]
        flat = np.concatenate(terms)
        count = np.zeros((self.block_radius[0].size, len(terms)))
        np.add.at(count, (block[flat], np.repeat(np.arange(len(terms)), [len(t) for t in terms])), 1)
        near = np.stack([np.add.reduceat(c[flat], start) for c in self.centre])
        by_block = np.stack(self.block_radius) @ np.sqrt(count)
        whole = np.outer(self.radius, np.sqrt([len(t) for t in terms]))
        return (near + np.minimum(by_block, whole)) * (1 + SAFE) + SAFE

    def best(self, wanted: np.ndarray, bound: list[float], k: int, least: int, ids: np.ndarray, no_id: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best rows for the item whose terms ``wanted`` marks, of those that score
        ``least`` or more; ties by id, null last."""
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if -top < least:
                break
            if self.child[node]:
                for c in (self.child[node], self.child[node] + 1):
                    if bound[c] >= least:
                        heapq.heappush(heap, (-bound[c], c))
                continue
            a, b = self.first[node], self.last[node]
            x, y = self.rows.start[a], self.rows.start[b]
            found = np.add.reduceat(self.rows.vals[x:y] * wanted[self.rows.cols[x:y]], self.rows.start[a:b] - x)
            good = np.flatnonzero(found >= least)
            if not len(good):
                continue
            rows, scores = np.concatenate([rows, self.order[a + good]]), np.concatenate([scores, found[good]])
            order = np.lexsort((ids[rows], no_id[rows], -scores))[:k]
            rows, scores = rows[order], scores[order]
            if len(rows) == k:
                least = max(least, int(scores[-1]))
        return rows, scores


def _search(items: Items, weight: np.ndarray, n_docs: int, n_terms: int, k: int, least: np.ndarray, shard_docs: int):
    """A function from batches of counted documents to ``item`` (its place), ``doc`` and ``score``."""
    width = len(items.index)

    def trees(part: pa.Table) -> Iterator[pa.RecordBatch]:
        lists = part.column("terms").combine_chunks()
        start = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        cols = lists.flatten().to_numpy().astype(np.int64)
        tf = part.column("tf").combine_chunks().flatten().to_numpy()
        row = np.repeat(np.arange(len(part)), np.diff(start))
        vals = weight[cols] * saturated(tf, part.column("n").to_numpy(), row, n_docs, n_terms)
        ids = part.column("doc").fill_null(0).to_numpy()
        no_id = part.column("doc").is_null().to_numpy()
        for at in range(0, len(items.terms), ITEMS_AT_ONCE):
            asked = [i for i in range(at, min(at + ITEMS_AT_ONCE, len(items.terms))) if len(items.terms[i])]
            if not asked:
                continue
            used = np.zeros(width, bool)
            for i in asked:
                used[items.terms[i]] = True
            number = np.cumsum(used) - 1  # of the columns of these items
            block = items.owner[used] % BLOCKS
            keep = used[cols]
            size = np.bincount(row[keep], minlength=len(part))
            some = np.flatnonzero(size)
            if not len(some):
                continue
            rows = Rows(np.concatenate([[0], np.cumsum(size[some])]), number[cols[keep]], vals[keep])
            tree = BallTree(rows, int(used.sum()), block, BLOCKS)
            own = [number[items.terms[i]] for i in asked]
            bounds = tree.bounds(own, block)
            out: list[list[np.ndarray]] = [[], [], []]
            for j in np.flatnonzero(bounds[0] >= least[asked]).tolist():
                wanted = np.zeros(len(block), np.int64)
                wanted[own[j]] = 1
                found, scores = tree.best(wanted, bounds[:, j].tolist(), k, int(least[asked[j]]), ids[some], no_id[some])
                for x, y in zip(out, (np.full(len(found), asked[j]), some[found], scores)):
                    x.append(y)
            if out[0]:
                item, at_row, score = map(np.concatenate, out)
                yield pa.RecordBatch.from_arrays([
                    pa.array(item), part.column("doc").combine_chunks().take(pa.array(at_row)), pa.array(score)], ["item", "doc", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                b = batch.slice(at, 1024)
                held.append(b)
                n, size = n + b.num_rows, size + len(b.column(2).flatten())
                if n >= shard_docs or size >= SHARD_TERMS:
                    yield from trees(pa.Table.from_batches(held))
                    held, n, size = [], 0, 0
        if held:
            yield from trees(pa.Table.from_batches(held))

    return run


def _ranked(counted: DataFrame, run, k: int) -> DataFrame:
    found = counted.filter(F.size("terms") > 0).mapInArrow(run, "item bigint, doc bigint, score bigint")
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list[tuple], doc_id: str, text: str, k: int, shard_docs: int, sample: int) -> tuple[Items, DataFrame]:
    items = Items.of(rows)
    counted = written(count_terms(docs, doc_id, text, items.index), "counted")
    totals = counted.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_docs, n_terms, n_rows = map(int, totals)
    df = np.zeros(len(items.index), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("c")).toLocalIterator():  # a row per term of the items
        df[r["t"]] = r["c"]
    weight = weights(df, n_docs)
    least = np.ones(len(items.ids), np.int64)
    if n_rows > 2 * sample:
        some = counted.filter(F.pmod(F.xxhash64(F.lit(7), "doc", "n"), F.lit(1 << 30)) < (sample << 30) // n_rows)
        limits = _ranked(some, _search(items, weight, n_docs, n_terms, k, least, shard_docs), k).filter(F.col("rank") == k)
        for r in limits.select("item", "score").toLocalIterator():  # a row per item
            least[r["item"]] = r["score"]
    return items, _ranked(counted, _search(items, weight, n_docs, n_terms, k, least, shard_docs), k)


def ranked_search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", k: int = TOP,
    item_bytes: int = ITEM_BYTES, shard_docs: int = SHARD_DOCS, sample: int = SAMPLE,
) -> DataFrame:
    """For each row of ``items`` its ``k`` documents of highest score above 0 (all, if fewer): ``item_id``,
    ``rank`` from 1, ``doc_id`` and ``score``. Equal scores go by id, null last.

    Null and empty texts have no terms: such a document is never found, such an item finds nothing.
    Repeated rows are documents, and items, of their own. An empty table on either side gives an empty
    result. Texts may be of any length. Ids of documents are whole numbers, those of items of any kind;
    other columns are not read. The items are the small side: the documents are read once for every
    ``item_bytes`` of their texts.
    """
    spark = docs.sparkSession
    items = items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").cast("string").alias("body"))
    blocks = max(1, math.ceil(measure(items, "body")[1] / item_bytes))
    parts = []
    for k_block in range(blocks):
        # bounded by item_bytes on average; repeated items share a block
        rows = [tuple(r) for r in items.filter(F.pmod(F.xxhash64("id", "body"), F.lit(blocks)) == k_block).collect()]
        if not rows:
            continue
        found, ranked = _search_block(docs, rows, doc_id, text, k, shard_docs, sample)
        if blocks > 1:
            ranked = written(ranked, "ranked")
        names = spark.createDataFrame(list(enumerate(found.ids)), f"item bigint, item_id {items.schema['id'].dataType.simpleString()}")
        parts.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", F.col("doc").alias("doc_id"), "score"))
    if not parts:
        return items.select(F.col("id").alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    return reduce(DataFrame.unionByName, parts)


RANKED_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
), counted AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM words GROUP BY ALL),
sized AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counted GROUP BY doc_id),
totals AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sized),
weighed AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, totals GROUP BY term, docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked JOIN counted USING (term) JOIN weighed USING (term) JOIN sized USING (doc_id), totals
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
