"""Near-duplicates by SimHash: vantage-point trees over 64-bit fingerprints.

1. A fingerprint per row (Arrow batches), written once as a narrow table.
2. Equal fingerprints become one point. Points are dealt to shards by a small tree of vantage
   points; level ``j`` measures the distance in bit block ``j`` only. The blocks are disjoint, so
   what a point lacks to the other side of its splits adds up: by the triangle bound a shard needs
   a visit only if that sum is within the radius.
3. A shard builds a vantage-point tree over its points and asks it for the partners of its own and
   its visiting points; it returns a spanning forest of the links, never all pairs.
4. Components of the forest edges, by alternating stars in Spark.
5. Rows are kept or dropped by narrow keys; only the texts of rows that go or come twice are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..settings import written
from .batches import free_name, map_text, utf8, word_lists, worker_state
from .components import components

SHINGLE, RADIUS = 3, 3  # fixed by the contract
SHARD_POINTS = 32_768  # points that a shard has on average, at most
SPLIT_SAMPLE = 16  # points per shard that the splits are taken from, about 2 ** 20 at most
LEAF = 64
HELD_LINKS = 1 << 20  # links in memory before they are thinned to a forest
MAX_BITS = 1 << 27  # of the bitmap of rows that go or come twice (16 MiB)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = 42) -> int:
    """SimHash over the XXH64 of word shingles, repeats included; a bit is 1 if set in over half."""
    total, ones = 0, np.zeros(64, np.int64)
    carried: list[bytes] = []

    def add(parts) -> int:
        h = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(seed)), np.uint64)
        for at in range(0, len(h), 1 << 16):
            part = h[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
            ones[:] += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return len(h)

    for words in word_lists(text.lower()):  # bytes: only A-Z are lowered
        words = carried + words
        total += add(map(b" ".join, zip(*(words[k:] for k in range(shingle)))))
        carried = words[max(0, len(words) - shingle + 1):]
    if not total:
        if not carried:
            return 0
        total = add([b" ".join(carried)])
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = SHINGLE, column: str = "fp") -> DataFrame:
    """The columns of ``df`` but ``text``, and the fingerprint as a signed long. Null text: zero."""

    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(np.array([fingerprint(t, shingle) for t in utf8(texts)], np.uint64).view(np.int64))]

    def start():
        worker_state("fingerprints")  # what a stage before has remembered is not needed here
        return make

    return map_text(df, text, {column: "bigint"}, start)


class Shards:
    """A vantage-point tree of ``depth`` levels, fitted on a bounded sample of the points."""

    def __init__(self, sample: np.ndarray, depth: int, radius: int):
        self.depth, self.radius = depth, radius
        cuts = np.linspace(0, 64, depth + 1).astype(int) if depth else []
        block = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(cuts, cuts[1:])]
        self.block = np.array(block, np.uint64)
        self.vantage = np.zeros(1 << depth, np.uint64)  # by node, the root is 1
        self.limit = np.zeros(1 << depth, np.int64)  # near side: distance <= limit
        groups = {1: np.unique(sample)}
        for level in range(depth):
            following = {}
            for node, points in groups.items():
                if len(points):
                    self.vantage[node] = points[0]
                    d = np.bitwise_count((points ^ points[0]) & self.block[level]).astype(np.int64)
                    sizes = np.bincount(d).cumsum()
                    self.limit[node] = int(np.abs(sizes - len(points) / 2).argmin())
                    near = d <= self.limit[node]
                    following |= {2 * node: points[near], 2 * node + 1: points[~near]}
                else:
                    following |= {2 * node: points, 2 * node + 1: points}
            groups = following

    def _distance(self, points: np.ndarray, node: np.ndarray, level: int) -> np.ndarray:
        return np.bitwise_count((points ^ self.vantage[node]) & self.block[level]).astype(np.int64)

    def home(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for level in range(self.depth):
            node = 2 * node + (self._distance(points, node, level) > self.limit[node])
        return node

    def visits(self, points: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of points and the shards after their own one that may hold a partner. Of two
        partners in different shards the one in the earlier shard visits, so a pair is met once."""
        at, node = np.arange(len(points)), np.ones(len(points), np.int64)
        left = np.full(len(points), self.radius)
        for level in range(self.depth):
            d, limit = self._distance(points[at], node, level), self.limit[node]
            gaps = np.maximum(0, d - limit), np.maximum(0, limit + 1 - d)  # to the near, the far side
            keep = [left >= g for g in gaps]
            at, node, left = (np.concatenate(x) for x in zip(*(
                (at[k], 2 * node[k] + side, left[k] - g[k]) for side, (k, g) in enumerate(zip(keep, gaps)))))
        later = node > home[at]
        return at[later], node[later]


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` nodes reaches over the edges ``a - b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        found = label.copy()
        np.minimum.at(found, label[a], low)
        np.minimum.at(found, label[b], low)
        while (jump := found[found]).tobytes() != found.tobytes():
            found = jump
        if (found == label).all():
            return label
        label = found


def links(points: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (query, point) whose components are those of all links within ``radius``.

    ``queries`` begins with ``points``. The tree is walked with all queries of a node at once: by the
    triangle bound a query skips a side that its ball can't reach, and is linked without a look
    below a node that lies within its ball as a whole.
    """
    left: list[np.ndarray] = [np.empty(0, np.int64)]
    right: list[np.ndarray] = [np.empty(0, np.int64)]
    held = 0

    def link(q, p) -> None:
        nonlocal held
        q, p = np.broadcast_arrays(q, p)
        left.append(q)
        right.append(p)
        held += q.size
        if held > HELD_LINKS + 4 * len(queries):  # a dense clump: a spanning forest says the same
            label = _labels(len(queries), np.concatenate(left), np.concatenate(right))
            left[:], right[:] = [np.arange(len(queries))], [label]
            held = len(queries)

    stack = [(np.arange(len(points)), np.arange(len(queries)))]
    while stack:
        own, asked = stack.pop()
        if not len(own) or not len(asked):
            continue
        if len(own) <= LEAF:
            for at in range(0, len(asked), 1 << 14):
                some = asked[at:at + (1 << 14)]
                near = np.bitwise_count(queries[some][:, None] ^ points[own][None, :]) <= radius
                count = near.sum(axis=1)
                link(some[count > 0], own[near[count > 0].argmax(axis=1)])
                if (count > 1).any():  # points with a common partner, once for each set of points
                    masks = np.unique(np.packbits(near[count > 1], axis=1), axis=0)
                    row, col = np.nonzero(np.unpackbits(masks, axis=1, count=len(own)))
                    first = np.searchsorted(row, np.arange(len(masks)))
                    link(own[col], own[col[first[row]]])
            continue
        vantage = points[own[len(own) // 2]]
        d = np.bitwise_count(points[own] ^ vantage).astype(np.int64)
        dq = np.bitwise_count(queries[asked] ^ vantage).astype(np.int64)
        whole = dq + d.max() <= radius
        if whole.any():
            inside = asked[whole]
            link(inside[0], own)
            link(inside, own[0])
            asked, dq = asked[~whole], dq[~whole]
        limit = int(np.median(d))
        if limit >= d.max():
            limit = int(d.max()) - 1  # points are distinct, so the vantage point stays on the near side
        stack.append((own[d <= limit], asked[dq - radius <= limit]))
        stack.append((own[d > limit], asked[dq + radius > limit]))
    return np.concatenate(left), np.concatenate(right)


def _forest(table: pa.Table, radius: int) -> pa.Table:
    fp = table.column("fp").to_numpy().view(np.uint64)
    own = table.column("own").to_numpy(zero_copy_only=False).astype(bool)
    queries = np.concatenate([fp[own], fp[~own]])
    label = _labels(len(queries), *links(queries[: own.sum()], queries, radius))
    moved = np.flatnonzero(label != np.arange(len(queries)))
    ids = queries.view(np.int64)
    return pa.table({"u": ids[moved], "v": ids[label[moved]]})


def linked_prints(prints: DataFrame, radius: int = RADIUS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """Edges ``u, v`` between the distinct longs in ``fp`` (one row each) that differ in at most
    ``radius`` bits: a spanning forest per shard. Every such pair is connected by the edges."""
    n = prints.count()
    depth = min(16, math.ceil(math.log2(max(1, n / shard_points))))
    wanted = ((SPLIT_SAMPLE << depth) << 30) // max(1, n) if depth else 0
    few = prints.select("fp").filter(F.pmod(F.xxhash64(F.lit(7), "fp"), F.lit(1 << 30)) < wanted)
    sample = few.toArrow().column("fp").to_numpy() if depth else np.empty(0, np.int64)
    tree = Shards(sample.astype(np.int64).view(np.uint64), depth, radius)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            home = tree.home(fp)
            at, shard = tree.visits(fp, home)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([home, shard])), pa.array(np.concatenate([fp, fp[at]]).view(np.int64)),
                 pa.array(np.arange(len(fp) + len(at)) < len(fp))], ["shard", "fp", "own"])

    dealt = prints.select("fp").mapInArrow(deal, "shard bigint, fp bigint, own boolean")
    return dealt.groupBy("shard").applyInArrow(lambda t: _forest(t, radius), "u bigint, v bigint")


def _classed(docs: DataFrame, doc_id: str, text: str, shingle: int = SHINGLE, radius: int = RADIUS, shard_points: int = SHARD_POINTS) -> DataFrame:
    """The rows of :func:`near_duplicates`, and ``alone``: whether no other row is in the component."""
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.xxhash64(f"`{text}`").alias("text_hash"), F.col(f"`{text}`").alias("_text"))
    prints = written(with_fingerprint(rows, "_text", shingle), "prints")
    first = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("text_hash").alias("text_hash"))
    points = written(prints.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n")), "points")
    edges = components(linked_prints(points, radius, shard_points))
    roots = edges.groupBy("v").agg(F.count(F.lit(1)).alias("size"))
    member = edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(roots.select(F.col("v").alias("fp"), F.col("v").alias("root")))
    member = written(member.join(points, "fp"), "members")
    lowest = member.groupBy("root").agg(F.min("first").alias("low"), F.count(F.lit(1)).alias("size"))
    named = join_unique(member.select("fp", "root"), lowest, "root", "size", member.count()).select("fp", "low")
    alone = F.col("low").isNull() & (F.col("n") == 1)
    points = written(points.join(named, "fp", "left").select("fp", F.coalesce("low", "first").alias("first"), "n", alone.alias("alone")), "classes")
    return join_unique(prints, points, "fp", "n", prints.count()).select(F.col("_id").alias(doc_id), "text_hash", "fp", "first", "alone")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """One row per row of ``docs``: its id, ``text_hash``, ``fp``, and in ``first`` the id and hash of
    the first row of its component (smallest id, null ids last, then text hash).

    Null and empty texts have fingerprint zero and link like any other. Equal fingerprints are one
    point whatever their number. Repeated rows get equal results; an empty table an empty one.
    """
    return _classed(docs, doc_id, text, shingle, radius, shard_points).drop("alone")


def _parts(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ``rows`` whose ``key`` may be in ``keys`` (a column of that name, distinct), and those where it is
    not, told by a bitmap of bounded size that every task gets: neither part is shuffled."""
    bits = min(MAX_BITS, max(1 << 15, 1 << (16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(F.col(key)), F.lit(bits)) + 1
    bucket, held = free_name("_bucket", rows.columns), free_name("_held", rows.columns)
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias(bucket)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias(held))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(held), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = rows.withColumn(bucket, F.bitmap_bucket_number(place)).join(F.broadcast(maps), bucket, "left")
    found = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return marked.filter(found).drop(bucket, held), marked.filter(~found).drop(bucket, held)


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the first row stays, with all its columns.

    Rows are judged by narrow keys. Only those that go or come twice travel with their texts (and what a
    bitmap can't tell from them); all others stay in the task that reads them.
    """
    row = free_name("_row", docs.columns)
    first = F.concat_ws(":", F.col("first.id").cast("string"), F.col("first.text_hash").cast("string"))
    own = F.concat_ws(":", F.col(f"`{doc_id}`").cast("string"), F.col("text_hash").cast("string"))
    rows = _classed(docs, doc_id, text, **options).filter("NOT alone").select(own.alias(row), (own == first).alias("stays"))
    keys = rows.groupBy(row).agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n"))
    keys = written(keys.filter("NOT stays OR n > 1").select(row, "stays"), "keys")
    keyed = docs.withColumn(row, F.concat_ws(":", F.col(f"`{doc_id}`").cast("string"), F.xxhash64(f"`{text}`").cast("string")))
    travel, stay = _parts(keyed, row, keys.select(row))
    kept = travel.dropDuplicates([row]).join(keys.filter("NOT stays").select(row), row, "left_anti")
    return stay.unionByName(kept).drop(row).select(*(f"`{c}`" for c in docs.columns))
