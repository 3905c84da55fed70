"""Spelling variants: words one edit apart, found by bit-sliced position indexes over the vocabulary.

1. Words are counted in Arrow batches, summed per task and then in Spark.
2. Two words one edit apart agree in ``a`` first and ``b`` last letters with ``a + b >= s - 1``, ``s``
   being the shorter length. So for some cut ``i`` from 0 to ``s - 1`` they share the first ``i`` and the
   last ``s - 1 - i`` letters. The cuts are grouped to a few intervals; words meet under what all
   cuts of an interval have in common. An interval that brings too many words together is taken
   cut by cut, after which two letters at most are free.
3. A shard holds, for its words, a bitset per position and letter. All its words of one length go
   through the same recurrences, 64 words of the index at a time: the words that agree so far, that
   differ in one letter so far, and that have one letter more, whose positions are shifted by one.
4. Best partners are reduced per shard and then per word; roots follow by doubling.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written
from .batches import chunks, slices, utf8

LETTER = r"[A-Za-zÀ-ÿ]"
MIN_LENGTH, MIN_COUNT, RATIO = 7, 2, 10  # fixed by the contract
PARTS = 3  # intervals of cuts
HOT_KEY = 16_384  # words under one key before its interval is taken cut by cut
SHARD_ROWS = 32_768  # rows that a shard has on average
BLOCK = 1 << 16  # 64-bit words of one state of the recurrences
PLANES = 1 << 26  # bytes of bitsets that are kept; more are made anew for each block of words
HELD = 1 << 22  # bytes of words that a task counts before it hands them on
PAIRS = 1 << 18


def word_counts(docs: DataFrame, doc_id: str, text: str, min_length: int, garble: int | None) -> DataFrame:
    """``word`` and ``n`` of the runs of letters, A-Z lowered, of ``min_length`` letters or more. With
    ``garble`` a word loses a letter if the CRC-32 of ``<doc_id>:<word>`` divides by it, at that CRC
    modulo its length."""
    pattern = re.compile(f"{LETTER}{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        size = 0

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for b in slices(batch, 1):
                for doc, body in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                    start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for piece in chunks(body):
                        words = pattern.findall(piece.lower().decode())  # bytes: only A-Z are lowered
                        if garble:
                            for k, word in enumerate(words):
                                h = zlib.crc32(word.encode(), start)
                                if h % garble == 0:
                                    h %= len(word)
                                    words[k] = word[:h] + word[h + 1:]
                            words = [w for w in words if len(w) >= min_length]
                        held.update(words)
                        size += len(piece)
                        if size > 8 * HELD and sum(map(len, held)) > HELD:
                            yield flush()
                        if size > 8 * HELD:
                            size = 0
        if held:
            yield flush()

    parts = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def bounds(s: int, part: int, parts: int) -> tuple[int, int]:
    """The first and last cut of an interval, for words of ``s`` letters and one more; from ``parts``
    on, an interval is one cut."""
    return (part * s // parts, (part + 1) * s // parts - 1) if part < parts else (part - parts, part - parts)


def _keyed(rows: DataFrame, low: str, high: str) -> DataFrame:
    """Adds ``key``, a hash of class, interval and the letters that all cuts from ``low`` to ``high`` share."""
    return rows.withColumn("key", F.expr(f"xxhash64(s, part, left(word, {low}), right(word, s - 1 - {high}))"))


def _dealt(words: DataFrame, min_length: int, parts: int, hot_key: int) -> DataFrame:
    """``key, s, part, word, n``: each word once per class (its own length, and one less, where it is the
    longer one) and interval."""
    pairs = F.expr(f"""filter(flatten(transform(array(length(word), length(word) - 1),
        c -> transform(sequence(0, {parts - 1}), p -> named_struct('s', c, 'part', p)))), x -> x.s >= {min_length})""")
    rows = words.select("word", "n", F.inline(pairs))
    rows = _keyed(rows, f"(part * s) div {parts}", f"(((part + 1) * s) div {parts} - 1)")
    hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > hot_key).select("key")
    hot = written(hot, "hot_keys")
    if hot.isEmpty():
        return rows
    # at most a share 1 / hot_key of the rows are hot keys
    cuts = F.expr(f"sequence((part * s) div {parts}, ((part + 1) * s) div {parts} - 1)")
    fine = rows.join(F.broadcast(hot), "key").select("s", "word", "n", F.explode(cuts).alias("cut"))
    fine = _keyed(fine.withColumn("part", F.col("cut") + parts), "cut", "cut").select(*rows.columns)
    return rows.join(F.broadcast(hot), "key", "left_anti").select(*rows.columns).unionByName(fine)


class Index:
    """Bitsets over words of ``s`` and ``s + 1`` letters: for each position and letter the words that
    have it there. ``codes`` has a row per word, 0 behind its end."""

    def __init__(self, codes: np.ndarray, letters: int):
        self.codes, self.letters = codes, letters
        self.width = (len(codes) + 63) // 64
        self.kept: dict[int, np.ndarray] | None = {} if codes.shape[1] * letters * self.width * 8 <= PLANES else None

    def pack(self, flags: np.ndarray) -> np.ndarray:
        """Flags per word as 64-bit words, along the last axis."""
        out = np.zeros((*flags.shape[:-1], self.width * 8), np.uint8)
        packed = np.packbits(flags, axis=-1, bitorder="little")
        out[..., :packed.shape[-1]] = packed
        return out.view(np.uint64)

    def plane(self, position: int) -> np.ndarray:
        """The bitsets of a position, by letter."""
        if self.kept is not None and position in self.kept:
            return self.kept[position]
        made = self.pack(self.codes[:, position][None, :] == np.arange(self.letters, dtype=self.codes.dtype)[:, None])
        if self.kept is not None:
            self.kept[position] = made
        return made

    def near(self, asked: np.ndarray, s: int) -> np.ndarray:
        """For each row of ``asked`` (words of ``s`` letters) the words with one letter replaced or one more."""
        shape = len(asked), self.width
        same = np.full(shape, ~np.uint64(0))
        replaced = np.zeros(shape, np.uint64)
        longer = same  # one letter more, so far in front
        for j in range(s):
            here, after = self.plane(j)[asked[:, j]], self.plane(j + 1)[asked[:, j]]
            replaced &= here
            replaced |= same & ~here
            same = same & here
            longer = (longer & after) | same
        last = self.codes[:, s] != 0
        return (replaced & self.pack(~last)) | (longer & self.pack(last))


def _pairs(found: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and bit numbers of the bits set, a bounded number at a time."""
    rows, cols = np.nonzero(found)
    for at in range(0, len(rows), PAIRS // 8):
        r, c = rows[at:at + PAIRS // 8], cols[at:at + PAIRS // 8]
        bits = np.unpackbits(found[r, c].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        k, bit = np.nonzero(bits)
        yield r[k], c[k] * 64 + bit


class _Best:
    """Number of partners and best partner (largest count, then smallest word) of each word."""

    def __init__(self, n: np.ndarray, rank: np.ndarray):
        self.n, self.rank = n, rank
        self.count = np.zeros(len(n), np.int64)
        self.best = np.full(len(n), -1)

    def add(self, word: np.ndarray, partner: np.ndarray) -> None:
        np.add.at(self.count, word, 1)
        known = np.flatnonzero(self.best >= 0)
        known = known[np.isin(known, word)]
        word, partner = np.concatenate([word, known]), np.concatenate([partner, self.best[known]])
        order = np.lexsort((self.rank[partner], -self.n[partner], word))
        word, partner = word[order], partner[order]
        first = np.flatnonzero(np.diff(word, prepend=-1))
        self.best[word[first]] = partner[first]


def matched(words: list[str], n: np.ndarray, s: int, cuts: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The number of partners and the best partner (-1: none) of each of the words of ``s`` and ``s + 1``
    letters, of the pairs whose first cut lies in ``cuts``."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    alphabet, letter = np.unique(flat, return_inverse=True)
    kind = np.uint8 if len(alphabet) < 255 else np.int32
    size = np.array([len(w) for w in words])
    codes = np.zeros((len(words), s + 1), kind)
    codes[np.arange(s + 1)[None, :] < size[:, None]] = letter + 1
    index = Index(codes, len(alphabet) + 1)
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    best = _Best(n, rank)
    short = np.flatnonzero(size == s)
    step = max(1, BLOCK // max(1, index.width))
    for at in range(0, len(short), step):
        some = short[at:at + step]
        for row, other in _pairs(index.near(codes[some], s)):
            word = some[row]
            longer = size[other] > s
            # a longer partner may be met under many cuts: the first one counts
            ends = np.zeros(len(word), np.int64)
            open_ = np.ones(len(word), bool)
            for t in range(1, s + 1):
                open_ &= codes[word, s - t] == codes[other, s + longer - t]
                if not open_.any():
                    break
                ends += open_
            cut = np.maximum(0, s - 1 - ends)
            good = (cut >= cuts[0]) & (cut <= cuts[1])
            word, other, longer = word[good], other[good], longer[good]
            best.add(word, other)
            best.add(other[longer], word[longer])
    return best.count, best.best


def _shard(table: pa.Table, parts: int) -> pa.Table:
    s, part = (table.column(c).to_numpy() for c in ("s", "part"))
    n = table.column("n").to_numpy()
    order = np.lexsort((part, s))
    out: list[tuple[pa.Array, ...]] = []
    edges = np.flatnonzero(np.diff(s[order], append=-1) | np.diff(part[order], append=-1)) + 1
    for a, b in zip(np.concatenate([[0], edges[:-1]]), edges):
        rows = order[a:b]
        if len(rows) < 2:
            continue
        word = table.column("word").take(pa.array(rows)).combine_chunks()
        count, best = matched(word.to_pylist(), n[rows], int(s[rows[0]]), bounds(int(s[rows[0]]), int(part[rows[0]]), parts))
        hit = np.flatnonzero(count)
        partner = pa.array(best[hit])
        out.append((word.take(pa.array(hit)), pa.array(count[hit]), pa.array(n[rows][best[hit]]), word.take(partner)))
    names = ["word", "n_near", "form_n", "form"]
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    return pa.Table.from_batches([pa.RecordBatch.from_arrays(list(x), names) for x in out], schema)


def near_words(words: DataFrame, min_length: int = MIN_LENGTH, parts: int = PARTS, hot_key: int = HOT_KEY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Of the distinct ``word`` with count ``n`` (words of ``min_length`` letters or more): those that have
    a word one edit away, with ``n_near`` (how many), and the one of largest count in ``form, form_n``."""
    rows = _dealt(words, min_length, parts, hot_key)
    shards = max(1, rows.count() // shard_rows)
    dealt = rows.select(F.pmod("key", F.lit(shards)).alias("shard"), "s", "part", "word", "n")
    found = dealt.groupBy("shard").applyInArrow(lambda t: _shard(t, parts), "word string, n_near bigint, form_n bigint, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` of the words with a form. Each form has ``RATIO`` times the count of its word,
    so chains are short; every round doubles what is followed."""
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(links.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if links.filter("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def spelling_variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO,
    garble: int | None = None, **options,
) -> DataFrame:
    """One row per word of ``min_length`` letters or more that occurs ``min_count`` times or more: ``word``,
    its count ``n``, ``n_near`` (words one inserted, deleted or replaced letter away), ``form`` (the near
    word of largest count, ties: the smallest, if that count is at least ``ratio`` times ``n``) with
    ``form_n``, and ``root`` (the end of the chain of forms, the word itself without one).

    Words are whole runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lowered. Null and empty texts have none; a null
    id counts as an empty one where ``garble`` asks for it; repeated rows count as often as they are
    there. An empty table gives an empty one. Texts may be of any length; a run of letters of any
    length is one word. Other columns are not read.
    """
    counts = word_counts(docs, doc_id, text, min_length, garble).filter(F.col("n") >= min_count)
    words = written(counts, "vocabulary")
    near = near_words(words, min_length, **options)
    has = F.col("form_n") >= ratio * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has, F.col("form")).alias("form"), F.when(has, F.col("form_n")).alias("form_n"))
    judged = written(judged, "forms")
    roots = _roots(judged.filter("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
