"""Similarity join on words: records and labels whose word sets have a Jaccard share of at least a threshold.

Words are put into one order for both sides, rare ones first. Two sets that reach the threshold share some
words among the first of each (the prefix), so only prefixes are looked up, and a frequent word is in few of
them. How long a prefix must be depends on the lengths of both sets. Numbers of common prefix words and lengths rule
out most pairs that meet; the rest is counted exactly.

Pairs are never stored: labels are cut by length into blocks that fit the broadcast bound, each with an index of
its prefix words, and a pass over the records of fitting lengths writes the best ``k`` sets of each record only. Sets
lie in order of their lengths, so a pass reads only files that have some of these.
Equal word sets are looked up once, whatever their number.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import words
from ..settings import fresh_path, row_keyed, setting, written
from .numbering import numbered
from .skew import join_unique

__all__ = ["word_matches"]

DIGITS = 6
MORE = 8  # words of a prefix beyond the least, and so the words that two prefixes must share, if the sets must share so many
CLASSES = 8  # lengths of rows that a list of the index is cut for
LONG = 2 * CLASSES  # shorter lists of the index are not cut
MEETS = 1 << 18  # meets of sets that are counted at once
RUN = 1 << 19  # words of rows that are looked up at once
STEP = 1 << 20  # words of label sets that are compared with a record at once
BITS = 1 << 15  # of a bitmap that Spark makes
PLACES = 1 << 18  # of the table that holds the words of one set, a power of two


def _sides(df: DataFrame, labels: DataFrame, key: str, text: str, label_text: str) -> DataFrame:
    """Rows and labels in one written table: distinct words as sorted lists in ``words`` and their ``digest``, a
    number and ``key`` or ``label`` and ``path``. Those without a word are left out."""
    nothing = [F.lit(None).cast(labels.schema[c].dataType).alias(c) for c in ("label", "path")]
    left = df.select(F.lit(True).alias("of_row"), F.col(key).alias("_key"), *nothing, F.col(text).alias("_text"))
    right = labels.select(F.lit(False).alias("of_row"), F.lit(None).cast(df.schema[key].dataType).alias("_key"), "label", "path", F.col(label_text).alias("_text"))
    told = left.unionByName(right).filter(F.rlike(F.lower("_text"), F.lit(r"[\p{L}\p{N}]")))  # a filter on the words would cut the texts twice
    both = told.withColumn("words", F.sort_array(F.array_distinct(words("_text")))).drop("_text")
    digest = F.unhex(F.sha2(F.array_join("words", " "), 256))  # no word has a blank
    return row_keyed(both.withColumn("digest", digest), "number")


def _different(sides: DataFrame) -> DataFrame:
    """One row per different set, numbered by the first label and path that it has: ``set, digest, number, of_row, of_label``.

    The words themselves stay where they are: ``number`` is a row that has them."""
    name = F.when(~F.col("of_row"), F.struct("label", "path"))
    sets = sides.groupBy("digest").agg(F.min("number").alias("number"), F.max("of_row").alias("of_row"), F.min(name).alias("f"))
    placed = numbered(sets, [F.col("f.label").asc(), F.col("f.path").asc()], "set")
    return placed.select("set", "digest", "number", "of_row", F.col("f").isNotNull().alias("of_label"))


def _chosen(sets: DataFrame) -> dict[int, np.ndarray]:
    """Whether the row of a number is one of ``sets``: a bit for each row, in arrays of ``BITS`` numbers."""
    spot = F.col("number") + 1
    parts = sets.groupBy(F.bitmap_bucket_number(spot)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot))).collect()
    return {bucket - 1: np.frombuffer(bits, np.uint8) for bucket, bits in parts}


def _own(numbers: np.ndarray, chosen: dict[int, np.ndarray]) -> np.ndarray:
    out, bucket = np.zeros(len(numbers), bool), numbers // BITS
    for b in np.unique(bucket):
        if b in chosen:
            here = bucket == b
            out[here] = np.unpackbits(chosen[b], bitorder="little")[numbers[here] % BITS]
    return out


def _common_words(known: DataFrame, room: int) -> int:
    """The number from which words, from the most frequent down, fit ``room`` bytes."""
    n = known.count()
    step = max(1, -(-n // 1000))
    sizes = known.groupBy(F.floor(F.col("at") / step).alias("s")).agg(F.sum(F.octet_length("word") + 12).alias("b")).collect()  # 1000 rows
    first = n
    for s, b in sorted(map(tuple, sizes), reverse=True):
        room -= b
        if room < 0:
            break
        first = s * step
    return first


def _ordered(sides: DataFrame, sets: DataFrame) -> DataFrame:
    """``set, of_row, of_label``, the set as word numbers in ``ids``, rare words first, and its size ``n``.

    Words are counted and numbered where they lie. Only those that are not among the frequent ones, of which as many
    are shipped as fit a quarter of the broadcast bound, are shuffled.
    """
    spark = sides.sparkSession
    chosen = spark.sparkContext.broadcast(_chosen(sets))
    lists = sides.select("number", "words")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = b.column(1).filter(pa.array(_own(b.column(0).to_numpy(), chosen.value)))
            yield pa.RecordBatch.from_arrays(own.flatten().value_counts().flatten(), ["word", "n"])

    counts = lists.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("times"))
    known = numbered(counts, [F.col("times").asc(), F.col("word").asc()], "at").select("word", "times", F.col("at").cast("int").alias("at"))
    first = _common_words(known, setting(spark, "broadcastBytes") // 4)
    frequent = known.filter(F.col("at") >= first).select("word", "at").toArrow()
    shared = spark.sparkContext.broadcast((frequent.column("word").combine_chunks(), frequent.column("at").to_numpy()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, numbers = shared.value
        for b in batches:
            own = pa.array(_own(b.column(0).to_numpy(), chosen.value))
            key, own = b.column(0).filter(own), b.column(1).filter(own)
            n, said = own.value_lengths().to_numpy().astype(np.int64), own.flatten()
            at = pc.index_in(said, value_set=names)
            is_known = at.is_valid().to_numpy(zero_copy_only=False)
            row, here = np.repeat(np.arange(len(n)), n), numbers[at.drop_null().to_numpy()]
            parts = []
            for kept, values in ((is_known, pa.array(here, pa.int32())), (~is_known, said.filter(pa.array(~is_known)))):
                cuts = np.append(0, np.cumsum(np.bincount(row[kept], minlength=len(n)))).astype(np.int32)
                parts.append(pa.ListArray.from_arrays(pa.array(cuts), values))
            yield pa.RecordBatch.from_arrays([key, pa.array(n, pa.int32()), *parts], ["number", "n", "ids", "rest"])

    table = written(lists.mapInArrow(place, "number bigint, n int, ids array<int>, rest array<string>"), "word_numbers")
    if first:
        rare = known.filter(F.col("at") < first)
        total = rare.agg(F.sum("times")).first()[0]
        found = join_unique(table.select("number", F.explode("rest").alias("word")), rare, "word", "times", total)
        more = found.groupBy("number").agg(F.collect_list("at").alias("more"))
        table = table.join(more, "number", "left").withColumn("ids", F.concat("ids", F.coalesce("more", F.array().cast("array<int>"))))
    named = table.join(sets.select("set", "number", "of_row", "of_label"), "number")
    return named.select("set", "of_row", "of_label", "n", F.sort_array("ids").alias("ids"))


def _least(threshold: float, n: np.ndarray) -> np.ndarray:
    """The least common words of a set of ``n`` and one that reaches the threshold; shares are rounded, so a little less does."""
    return np.maximum(1, np.ceil(np.round((threshold - 0.5 * 10.0**-DIGITS) * n, 9))).astype(np.int64)


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``start .. start + length - 1`` of all runs, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _common(threshold: float, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The least common words of two sets of ``n`` and ``m`` that reach the threshold."""
    share = threshold - 0.5 * 10.0**-DIGITS
    return np.maximum(1, np.ceil(np.round(share / (1 + share) * (n + m), 9) - 1e-9)).astype(np.int64)


def _prefix(threshold: float, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How many of the first of ``n`` words are looked at for sets of ``m`` words or more that may reach the threshold."""
    return np.minimum(n, n - _common(threshold, n, np.maximum(m, _least(threshold, n))) + MORE)


def _ranges(labels: DataFrame, bound: int, threshold: float) -> Iterator[tuple[int, int, int, int]]:
    """Blocks of labels in the order of their lengths, of ``bound`` bytes or a single set: first place, end, lengths."""
    first = at = size = low = 0
    # one row per length: fewer than the root of twice the number of all words
    for n, times in sorted(map(tuple, labels.groupBy("n").agg(F.count(F.lit(1))).collect())):
        # a word takes four bytes in its set and eight, if not met in many sets, in the index
        room = 4 * n + 8 * int(_prefix(threshold, np.array(n), np.array(0)))
        low = low or n
        while times:
            fit = min(times, max(0, bound - size) // room)
            if not fit and at > first:
                yield first, at, low, last
                first, size, low = at, 0, n
                continue
            fit = max(fit, 1)
            at, size, times, last = at + fit, size + fit * room, times - fit, n
    if at > first:
        yield first, at, low, last


class _Index(NamedTuple):
    """Sets of a block in order of length, and for the words of their prefixes the sets that have them. The list of a word
    begins with the sets that are to be met by rows of any length; those for short rows only come last."""

    number: np.ndarray
    n: np.ndarray
    words: np.ndarray  # of all sets, one after the other
    starts: np.ndarray
    edges: np.ndarray  # least lengths of the classes of rows
    known: np.ndarray  # words of prefixes
    lists: np.ndarray  # where their lists begin, and the end
    place: np.ndarray  # of a long list in ``ends``, or -1
    ends: np.ndarray  # where a long list ends for a class of rows
    holder: np.ndarray  # the lists


def _index(block: pa.Table, threshold: float) -> _Index:
    order = np.argsort(block.column("n").to_numpy(), kind="stable")
    block = block.take(order)
    number, n = block.column("set").to_numpy(), block.column("n").to_numpy().astype(np.int64)
    words, starts = block.column("ids").combine_chunks().flatten().to_numpy(), np.cumsum(n) - n
    low, high = int(_least(threshold, n[0])), n[-1] / threshold + 1
    edges = np.unique((low * (high / low) ** (np.arange(CLASSES) / CLASSES)).astype(np.int64))
    kept = np.stack([_prefix(threshold, n, e) for e in edges])  # fewer for longer rows
    prefix = words[_runs(starts, kept[0])]
    holder = np.repeat(np.arange(len(n), dtype=np.int32), kept[0])
    at = _runs(np.zeros(len(n), np.int64), kept[0]).astype(np.int32)
    few = sum((at >= np.repeat(k.astype(np.int32), kept[0])).astype(np.int8) for k in kept)  # classes that need not meet it
    known, own = np.unique(prefix, return_inverse=True)
    spot = own.reshape(-1) * len(edges) + few
    sizes = np.bincount(spot, minlength=len(known) * len(edges))
    ends = np.cumsum(sizes).reshape(len(known), len(edges))[:, ::-1].astype(np.int32)
    lists = np.append(0, ends[:, 0]).astype(np.int32)
    long = np.diff(lists) > LONG
    place = np.where(long, np.cumsum(long) - 1, -1).astype(np.int32)
    return _Index(number, n, words, starts, edges, known, lists, place, ends[long], holder[np.argsort(spot, kind="stable")])


def _met(index: _Index, ids: np.ndarray, starts: np.ndarray, n: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of rows and of sets of the block whose prefixes share enough words, in order of the rows."""
    size = len(index.n)
    low = index.n[0]
    mine = _prefix(threshold, n, low)
    words, row = ids[_runs(starts, mine)], np.repeat(np.arange(len(n), dtype=np.int32), mine)
    at = np.minimum(np.searchsorted(index.known, words), len(index.known) - 1)
    hit = np.flatnonzero(index.known[at] == words)
    at, row = at[hit], row[hit]
    cut = np.searchsorted(index.edges, n, "right") - 1
    begin, end, place = index.lists[at], index.lists[at + 1], index.place[at]
    long = np.flatnonzero(place >= 0)
    end[long] = index.ends[place[long], cut[row[long]]]
    length = end - begin
    bounds = np.searchsorted(row, np.arange(len(n) + 1))
    total = np.append(0, np.cumsum(length, dtype=np.int64))[bounds]
    least = np.minimum(MORE, np.minimum(_common(threshold, n, np.maximum(low, _least(threshold, n))), _common(threshold, _least(threshold, low), low)))
    first = 0
    while first < len(n):
        last = max(first + 1, int(np.searchsorted(total, total[first] + MEETS, "right")) - 1)
        last = min(last, first + max(1, (2**31 - 1) // size))
        part = slice(bounds[first], bounds[last])
        both, shared = _counted(index.holder, begin[part], length[part], (row[part] - first) * np.int32(size), (last - first) * size, int(least[first:last].min()))
        a = first + both // size
        b, first = both - (a - first) * size, last
        x, y = n[a], index.n[b]
        need = _common(threshold, x, y)
        kept = _prefix(threshold, y, index.edges[cut[a]])
        # the last words of both prefixes: up to the lesser one all common words are counted
        before = ids[starts[a] + mine[a] - 1] <= index.words[index.starts[b] + kept - 1]
        good = (np.minimum(x, y) >= need) & (shared + np.where(before, x - mine[a], y - kept) >= need)
        if good.any():
            yield a[good], b[good]


def _counted(holder: np.ndarray, begin: np.ndarray, length: np.ndarray, base: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, ``base`` and what the lists hold, that come ``least`` times or more, sorted, and how often they come."""
    total = int(length.sum(dtype=np.int64))
    if total < least:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if total > size // 2:
        counts = np.zeros(size, np.int64)
        ends = np.cumsum(length, dtype=np.int64)
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, total, 4 * MEETS)), len(length)))
        for i, j in zip(cuts, cuts[1:]):  # a list is no longer than there are sets
            counts += np.bincount(_keys(holder, begin[i:j], length[i:j], base[i:j]), minlength=size)
        found = np.flatnonzero(counts >= least)
        return found, counts[found]
    keys = np.sort(_keys(holder, begin, length, base))
    often = keys[:total - least + 1][keys[least - 1:] == keys[:total - least + 1]]
    new = np.flatnonzero(np.append(True, often[1:] != often[:-1]))[:len(often)]
    return often[new].astype(np.int64), np.diff(np.append(new, len(often))) + least - 1


def _keys(holder: np.ndarray, begin: np.ndarray, length: np.ndarray, base: np.ndarray) -> np.ndarray:
    ends = np.cumsum(length, dtype=np.int32)
    at = np.repeat(begin - ends + length, length)
    at += np.arange(len(at), dtype=np.int32)
    keys = np.repeat(base, length)
    keys += holder.take(at)
    return keys


def _best(index: _Index, ids: np.ndarray, table: np.ndarray, met: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of the sets ``met`` for one set, and their shares in millionths. ``table`` is as it was afterwards."""
    n, sizes = len(ids), index.n[met]
    share = np.empty(len(met), np.int64)
    spots = ids & (PLACES - 1)
    table[spots] = ids
    lost = ids[table[spots] != ids]  # another word has their place
    cuts = np.searchsorted(np.cumsum(sizes), np.arange(STEP, sizes.sum(), STEP))
    for part in np.split(np.arange(len(met)), np.unique(cuts)):
        if len(part):
            m = sizes[part]
            theirs = index.words[_runs(index.starts[met[part]], m)]
            same = table[theirs & (PLACES - 1)] == theirs
            if len(lost):
                same |= np.isin(theirs, lost)
            common = np.add.reduceat(same, np.cumsum(m) - m, dtype=np.int64)
            both = n + m - common
            share[part] = (2 * 10**DIGITS * common + both) // (2 * both)  # halves up
    table[spots] = -1
    good = share >= round(threshold * 10**DIGITS)
    met, share = index.number[met[good]], share[good]
    first = np.lexsort((met, -share))[:k]
    return met[first], share[first]


def _by_length(sets: DataFrame) -> tuple[DataFrame, list[int]]:
    """The sets in order, those of labels first, short ones first, with their ``part`` and ``place`` in it; the places where parts begin."""
    ordered = sets.orderBy(F.col("of_label").desc(), "n", "set")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    table = written(ordered.withColumn("part", F.spark_partition_id()).withColumn("place", place), "sets_by_length")
    sizes = dict(map(tuple, table.groupBy("part").agg(F.count(F.lit(1))).collect()))  # one row per task that sorted
    return table, np.cumsum([0, *(sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1))]).tolist()


def _between(begins: list[int], first: int, end: int) -> Column:
    """Rows of :func:`_by_length` from place ``first`` to before ``end`` of all."""
    a, z = bisect_right(begins, first) - 1, bisect_right(begins, end - 1) - 1
    from_first = (F.col("part") > a) | (F.col("place") >= first - begins[a])
    return F.col("part").between(a, z) & from_first & ((F.col("part") < z) | (F.col("place") < end - begins[z]))


def _pairs(sets: DataFrame, k: int, threshold: float) -> DataFrame:
    """``a, b, score`` of the ``k`` best sets of labels for each set of rows, of those that reach the threshold."""
    spark = sets.sparkSession
    sets, begins = _by_length(sets)
    labels = sets.filter("of_label")
    path, pairs = fresh_path(spark, "word_pairs"), "a bigint, b bigint, share bigint"
    spark.range(0).select(*[F.col("id").alias(c) for c in ("a", "b", "share")]).write.parquet(f"{path}/block=-1")  # there may be no block

    def ready(block: tuple[int, int, int, int]) -> Broadcast:
        first, end, low, high = block
        own = labels.filter(F.col("n").between(low, high) & _between(begins, first, end))
        return spark.sparkContext.broadcast(_index(own.select("set", "n", "ids").toArrow(), threshold))

    blocks = list(_ranges(labels, max(1, setting(spark, "broadcastBytes")), threshold))
    with ThreadPoolExecutor(1) as ahead:  # the next block is made ready during the pass for this one
        coming = ahead.submit(ready, blocks[0]) if blocks else None
        for number, (_, _, low, high) in enumerate(blocks):
            shared = coming.result()
            coming = ahead.submit(ready, blocks[number + 1]) if number + 1 < len(blocks) else None

            def match(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                index, table = shared.value, np.full(PLACES, -1, np.int32)
                for b in batches:
                    cuts, ids, sets = b.column(1).offsets.to_numpy().astype(np.int64), b.column(1).values.to_numpy(), b.column(0).to_numpy()
                    first = 0
                    while first < len(sets):
                        last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + RUN, "right")) - 1)
                        starts, n = cuts[first:last], np.diff(cuts[first:last + 1])
                        for rows, met in _met(index, ids, starts, n, threshold):
                            new = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                            own = rows[new]
                            found = [_best(index, ids[starts[r]:starts[r] + n[r]], table, m, k, threshold) for r, m in zip(own, np.split(met, new[1:]))]
                            a = np.repeat(sets[first + own], [len(s) for s, _ in found])
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(a), pa.array(np.concatenate([s for s, _ in found])), pa.array(np.concatenate([s for _, s in found]))], ["a", "b", "share"])
                        first = last

            fitting = F.col("n").between(int(_least(threshold, np.array(low))), math.floor(high / (threshold - 10.0**-DIGITS)) if threshold > 10.0**-DIGITS else 2**31 - 1)
            sets.filter(F.col("of_row") & fitting).select("set", "ids").mapInArrow(match, pairs).write.parquet(f"{path}/block={number}")
            shared.destroy()
    found = spark.read.schema(pairs).parquet(path)
    best = found.groupBy("a").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("share")).alias("s"), "b"))), 1, k).alias("l"))
    return best.select("a", F.inline("l")).select("a", "b", (-F.col("s") / 10**DIGITS).alias("score"))


def word_matches(df: DataFrame, labels: DataFrame, k: int, threshold: float, *, key: str = "id", text: str = "text", label_text: str = "label_plus_desc") -> DataFrame:
    """``key, label, path, score, rank``: for each row of ``df`` the ``k`` labels that share most of their words with
    it, of a share of ``threshold`` (above 0) or more; ties by label and path.

    The share is the number of common words by that of all words of both, repeats not counted, rounded to
    six digits. Rows and labels without words match nothing. Ids may repeat or be NULL: every row is one of
    its own. Labels of one word set beyond the first ``k`` by name can't be among the best and are left out, as are
    word sets beyond the best ``k`` by share and first name.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is above 0 and at most 1")
    if "path" not in labels.columns:
        labels = labels.withColumn("path", F.lit(None).cast("string"))
    sides = _sides(df, labels, key, text, label_text)
    sets = _different(sides)
    pairs = _pairs(_ordered(sides, sets), k, threshold)

    first = F.row_number().over(Window.partitionBy("digest").orderBy("label", "path"))
    named = sides.filter("NOT of_row").select("digest", "label", "path").withColumn("_first", first).filter(F.col("_first") <= k)
    by_set = sets.filter("of_label").select(F.col("set").alias("b"), "digest").join(named, "digest").select("b", "label", "path")
    best = Window.partitionBy("a").orderBy(F.col("score").desc(), "label", "path")
    ranked = pairs.join(by_set, "b").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    lists = ranked.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("rank", "label", "path", "score"))).alias("best"))  # k at most
    found = sets.select(F.col("set").alias("a"), "digest").join(lists, "a").select("digest", "best")
    rows = sides.filter("of_row").select(F.col("_key").alias(key), "digest")
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("times"))
    found = join_unique(rows, found.join(sizes, "digest"), "digest", "times", rows.count())
    return found.select(key, F.inline("best")).select(key, "label", "path", "score", "rank")
