"""Exact duplicates by composable polynomial fingerprints, every match compared chunk by chunk.

1. The fingerprint of a text is the polynomial of its bytes at a fixed point, modulo a prime. Runs of
   bytes are hashed on their own and joined by shifting each by the length before it. A huge text is
   cut into pieces that are hashed in different tasks; any other text in the task that reads it.
2. Rows are counted per fingerprint on a narrow table.
3. Only the rows of fingerprints that occur twice or more travel with their texts (a bitmap of bounded
   size keeps the others from the shuffle). Their chunks are joined with the chunks of one text of the
   group and compared; a hot group is salted.
4. Fingerprints with a difference (a collision) are split into classes, a class a round.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import SHARE, join_unique
from ..settings import row_keyed, written
from .batches import free_name, map_text, utf8

MODULUS = (1 << 61) - 1
BASE = 1_162_261_467_000_133  # any number between 256 and the modulus will do
STEP = 1 << 16  # bytes that are hashed at once
PIECE = 1 << 20  # bytes of a piece of a huge text
HUGE = 1 << 24  # texts of more bytes are cut into pieces
CHUNK = 1 << 16  # bytes that are compared at once
MAX_BITS = 1 << 27  # of the bitmap of wanted fingerprints (16 MiB)


class Polynomial:
    """``sum(byte[i] * base ** i) mod modulus``, for a modulus below ``2 ** 61``."""

    def __init__(self, modulus: int = MODULUS, base: int = BASE):
        self.modulus, self.base = modulus, base % modulus
        powers, power = np.empty(STEP, np.uint64), 1
        for i in range(STEP):
            powers[i], power = power, power * base % modulus
        # two halves, so that sums over a step of bytes stay below 2 ** 64
        self.low, self.high, self.step = powers & np.uint64((1 << 31) - 1), powers >> np.uint64(31), power

    def of(self, data: bytes) -> int:
        total, shift = 0, 1
        for at in range(0, len(data), STEP):
            part = np.frombuffer(data, np.uint8, min(STEP, len(data) - at), at).astype(np.uint64)
            value = int(part @ self.low[:len(part)]) + (int(part @ self.high[:len(part)]) << 31)
            total = (total + shift * value) % self.modulus
            shift = shift * self.step % self.modulus
        return total

    def joined(self, runs: Iterable[tuple[int, int]]) -> tuple[int, int]:
        """The value and length of a text from those of its runs, in their order."""
        total = length = 0
        for value, n in runs:
            total = (total + pow(self.base, length, self.modulus) * value) % self.modulus
            length += n
        return total, length

    def key(self, value: int, length: int) -> int:
        """The fingerprint: the length is one more coefficient, as texts may end in zero bytes."""
        return (value * self.base + length) % self.modulus


def _bitmap(prints: DataFrame) -> np.ndarray:
    """A bit per residue of the fingerprints in ``fp``: at most ``MAX_BITS``, whatever their number."""
    bits = min(MAX_BITS, max(1 << 15, 1 << (16 * prints.count()).bit_length()))
    place = F.pmod("fp", F.lit(bits)) + 1
    maps = prints.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
    out = np.zeros((bits >> 15, 1 << 12), np.uint8)
    for r in maps.toLocalIterator():
        out[r["b"] - 1] = np.frombuffer(r["m"], np.uint8)
    return out.reshape(-1)


def _small(rows: DataFrame, modulus: int, wanted: np.ndarray | None = None) -> DataFrame:
    """The columns of ``rows`` but ``_text``, and ``fp`` and ``n_bytes``, hashed where they are read. With
    the bitmap ``wanted`` only rows that may be among them, and their normalised text in ``norm``."""
    new = {"fp": "bigint", "n_bytes": "bigint"} | ({} if wanted is None else {"norm": "binary"})

    def start():
        poly = Polynomial(modulus)

        def make(texts: pa.Array) -> list[pa.Array]:
            norm = [t.lower() for t in utf8(texts)]  # bytes: only A-Z are lowered
            prints = [poly.key(poly.of(t), len(t)) for t in norm]
            out = [pa.array(prints, pa.int64()), pa.array([len(t) for t in norm], pa.int64())]
            if wanted is not None:
                place = [p % (8 * len(wanted)) for p in prints]
                out.append(pa.array([t if wanted[p >> 3] >> (p & 7) & 1 else None for t, p in zip(norm, place)], pa.binary()))
            return out

        return make

    hashed = map_text(rows, "_text", new, start)
    return hashed if wanted is None else hashed.filter("norm IS NOT NULL")


def _pieces(huge: DataFrame, modulus: int, piece: int) -> DataFrame:
    """``_row``, ``fp`` and ``n_bytes`` of the huge texts, whose pieces are dealt over all tasks."""
    last = F.floor((F.octet_length("_text") - 1) / piece).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(F.col("_text").cast("binary"), i * piece + 1, F.lit(piece)))
    dealt = huge.select("_row", F.posexplode(cut).alias("at", "part")).repartition("_row", "at")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(modulus)
        for b in batches:
            parts = b.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), pa.array([poly.of(p.lower()) for p in parts], pa.int64()),
                pa.array([len(p) for p in parts], pa.int64())], ["_row", "at", "value", "n"])

    runs = dealt.mapInArrow(hashed, "_row bigint, at int, value bigint, n bigint")
    whole = runs.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("at", "value", "n"))).alias("runs"))  # at most 2 ** 31 / piece

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(modulus)
        for b in batches:
            found = [poly.joined((r["value"], r["n"]) for r in runs) for runs in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([poly.key(v, n) for v, n in found], pa.int64()), pa.array([n for _, n in found], pa.int64())],
                ["_row", "fp", "n_bytes"])

    return written(whole.mapInArrow(combined, "_row bigint, fp bigint, n_bytes bigint"), "pieces")


class _Texts:
    """The rows of a documents table with their fingerprints. Huge texts are written and hashed once."""

    def __init__(self, rows: DataFrame, modulus: int, huge: int, piece: int):
        self.modulus = modulus
        size = F.coalesce(F.octet_length("_text"), F.lit(0))
        self.small, large = rows.filter(size <= huge), rows.filter(size > huge)
        self.huge = None
        if not large.isEmpty():
            numbered = row_keyed(large)
            self.huge = numbered.join(_pieces(numbered, modulus, piece), "_row").drop("_row")

    def prints(self, *columns: str) -> DataFrame:
        rows = _small(self.small.select(*columns, "_text"), self.modulus)
        return rows if self.huge is None else rows.unionByName(self.huge.select(*rows.columns))

    def texts(self, wanted: DataFrame, *columns: str) -> DataFrame:
        """As ``prints``, with the normalised text in ``norm``; rows whose ``fp`` is not in ``wanted``
        are left out as far as a bitmap of bounded size tells them."""
        rows = _small(self.small.select(*columns, "_text"), self.modulus, _bitmap(wanted))
        if self.huge is None:
            return rows
        large = self.huge.select(*columns, "fp", "n_bytes", "_text")
        return rows.unionByName(map_text(large, "_text", {"norm": "binary"}, lambda: lambda t: [pa.array([x.lower() for x in utf8(t)], pa.binary())]))


def _differing(members: DataFrame, chosen: DataFrame, total: int, chunk: int) -> DataFrame:
    """``_row`` and ``fp`` of the ``members`` whose text is not that of the first ``chosen`` row of their
    fingerprint. Both have ``_row, fp, n, n_bytes, norm``; ``n`` is the size of the group."""
    first = chosen.groupBy("fp").agg(F.min("_row").alias("_row"))
    first = chosen.join(first.select("_row"), "_row", "left_semi")
    parts = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("n_bytes") - 1) / chunk)).cast("int")),
        lambda i: F.substring("norm", i * chunk + 1, F.lit(chunk)))
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") * SHARE / F.lit(max(1, total)))).cast("int")
    left = members.withColumn("_salt", F.pmod(F.xxhash64("_row"), salts).cast("int")).select("fp", "_salt", "_row", "n_bytes", F.posexplode(parts).alias("at", "part"))
    right = first.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    right = right.select("fp", "_salt", F.col("n_bytes").alias("_n"), F.posexplode(parts).alias("at", "_part"))
    compared = left.join(right, ["fp", "_salt", "at"], "left")
    same = (F.col("part") == F.col("_part")) & (F.col("n_bytes") == F.col("_n"))
    return compared.filter(~F.coalesce(same, F.lit(False))).select("_row", "fp").distinct()


def _classes(rows: DataFrame, total: int, chunk: int) -> DataFrame:
    """Split the rows of fingerprints with a collision: adds ``class``, equal for equal texts of a fingerprint.
    A round settles one class of every fingerprint; there are as many rounds as texts share one."""
    done, rest, k = [], rows, 0
    while not rest.isEmpty():
        bad = written(_differing(rest, rest, total, chunk), "differing")
        done.append(rest.join(bad, "_row", "left_anti").drop("norm").withColumn("class", F.lit(k)))
        rest, k = written(rest.join(bad, "_row", "left_semi"), "rest"), k + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def exact_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = MODULUS, huge: int = HUGE, piece: int = PIECE, chunk: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: its columns but the text, and ``keep_id`` (the largest id among the
    rows of equal text), ``group_size``, ``kept`` (whether this row stays) and ``n_bytes``; columns of
    these names are replaced.

    Texts are equal if they are identical after lower-casing A-Z; null is the empty text. A null id is
    smaller than any other; of repeated rows of the largest id one stays. An empty table gives an empty
    one. Texts of any length: a task holds one text and one chunk of another at a time, and a text of more
    than ``huge`` bytes is hashed by many tasks.
    """
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_doc"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    source = _Texts(rows, modulus, huge, piece)
    prints = written(source.prints("_doc", "_id").withColumn("_row", F.monotonically_increasing_id()), "prints")
    best = F.max(F.struct("_id", "_row")).alias("best")
    groups = written(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("group_size"), best), "groups")
    total = prints.count()

    several = groups.filter("n > 1").select("fp", F.col("best._id").alias("_best"), "group_size", "n")
    texts = join_unique(source.texts(several, "_id"), several, "fp", "n", total).withColumnRenamed("group_size", "n")
    members = written(texts.withColumn("_row", F.monotonically_increasing_id()), "members")
    mixed = written(_differing(members, members.filter("_id <=> _best"), total, chunk).select("fp").distinct(), "mixed")
    if mixed.isEmpty():
        out = join_unique(prints, groups, "fp", "n", total)
    else:
        split = source.texts(mixed, "_doc", "_id").join(mixed, "fp").join(groups.select("fp", "n"), "fp")
        split = _classes(written(split.withColumn("_row", F.monotonically_increasing_id()), "split"), total, chunk)
        split = split.drop("n").withColumn("key", F.concat_ws(":", "fp", "class"))
        parts = split.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("group_size"), best)
        rest = join_unique(prints.join(mixed, "fp", "left_anti"), groups.join(mixed, "fp", "left_anti"), "fp", "n", total)
        out = rest.unionByName(join_unique(split, parts, "key", "n", total).select(*rest.columns))
    new = {"keep_id": F.col("best._id"), "group_size": F.col("group_size"), "kept": F.col("_row") == F.col("best._row"), "n_bytes": F.col("n_bytes")}
    own = [F.col(f"_doc.`{c}`").alias(c) for c in kept if c.lower() not in new]
    return out.select(*own, *(c.alias(name) for name, c in new.items()))


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the table is written once, to number its rows."""
    row = free_name("_number", docs.columns)
    numbered = row_keyed(docs, row)
    judged = exact_duplicates(numbered.select(F.col(f"`{row}`").alias("number"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")), "id", "text", **options)
    return numbered.join(judged.filter("kept").select(F.col("number").alias(row)), row, "left_semi").drop(row)


EXACT_SQL = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), sized AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM texts JOIN sized USING (norm)
"""
