"""Keyword containment: a label matches when one of its terms is a substring of the lower text.

The result holds the first ``k`` matching labels in taxonomy order. Three forms give equal
results and are chosen by the measured size of the term table:

* ``inline``    terms bound as one array value, evaluated in the JVM with early stop, no shuffle
* ``automaton`` terms broadcast, one pass of a multi-pattern matcher per text, no shuffle
* ``blocks``    term table of any size: cut in taxonomy order into blocks that fit the broadcast bound,
                one such pass per block; the records are written once, the passes write what they
                find, and one join by row number brings it back

Terms hold no blanks, so a term stands in a text if it stands in one of its words. All forms look
at the distinct words of a text, a bounded run of texts at a time, and at each word of a run once.

Every row is matched by itself, so ids may repeat or be NULL. Where the ``ahocorasick`` package is
absent the matcher tries term by term, with the same result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import description_terms, empty_strings, name_terms
from ..settings import fresh_path, measure, row_keyed, setting, written
from .numbering import numbered

EDGE = "\x01"
RUN_WORDS = 1 << 18  # words of texts that are looked up at once, one text at least
KNOWN_WORDS, LONG_WORD = 1 << 17, 256  # words that a task remembers, and their greatest length

__all__ = ["label_terms", "match_keywords", "term_overlap"]


def label_terms(labels: DataFrame, strip_punct: bool = False) -> DataFrame:
    """Add ``terms``: words of the description, then parts of the name."""
    terms = F.array_distinct(F.concat(description_terms("description", strip_punct), name_terms("label")))
    return labels.withColumn("terms", F.filter(terms, lambda t: t != ""))


def match_keywords(
    df: DataFrame, text: str, labels: DataFrame, k: int = 5, *, out: str = "labels", key: str = "id",
    form: str = "auto", strip_punct: bool = False, word_match: bool = False,
) -> DataFrame:
    """Attach the first ``k`` matching labels as ``out``.

    ``word_match`` asks for whole words instead of substrings and strips punctuation from terms.
    ``key`` names the record id and is not read. A stream runs the passes of all blocks in one.
    """
    terms = label_terms(labels, strip_punct or word_match).select("label", "pos", "terms")
    if word_match:
        # a mark on both sides makes a whole word a substring
        terms = terms.withColumn("terms", F.transform("terms", lambda t: F.concat(F.lit(EDGE), t, F.lit(EDGE))))
        cut = F.regexp_replace(F.lower(F.col(text)), r"[^\p{L}\p{N}]+", f"{EDGE} {EDGE}")
        body = F.concat(F.lit(EDGE), cut, F.lit(EDGE))
    else:
        body = F.lower(F.col(text))
    if form == "auto":
        form = _choose(terms)
    if form == "inline":
        return _inline(df, body, terms, k, out)
    return _by_blocks(df, body, terms, k, out, _first, bound=None if form == "automaton" else setting(df.sparkSession, "broadcastBytes"))


def _choose(terms: DataFrame) -> str:
    spark = terms.sparkSession
    exploded = terms.select("label", F.explode("terms").alias("term"))
    n, size = measure(exploded, "label", "term")
    if n <= setting(spark, "inlineTerms") and size <= setting(spark, "inlineBytes"):
        return "inline"
    return "automaton" if size <= setting(spark, "broadcastBytes") else "blocks"


def _text_words(body: Column) -> Column:
    """The distinct words of a text. They are cut at blanks that no term holds, so they hold the terms of the text."""
    return F.array_distinct(F.split(body, r"[\x20\x09-\x0D]++"))


def _inline(df: DataFrame, body: Column, terms: DataFrame, k: int, out: str) -> DataFrame:
    table = terms.agg(F.array_sort(F.collect_list(F.struct("pos", "label", "terms")))).scalar()
    each = terms.select(F.explode("terms").alias("term"))
    few = each.agg((F.count_distinct("term") * 4 <= F.count("term")).alias("few")).first()["few"]

    def first_k(row: Column) -> Column:
        def step(found: Column, entry: Column) -> Column:
            hit = F.arrays_overlap(entry["terms"], row["known"]) if few else F.exists(entry["terms"], lambda t: F.contains(row["body"], t))
            return F.when(F.size(found) >= k, found).when(hit, F.array_append(found, entry["label"])).otherwise(found)

        return F.aggregate(row["table"], empty_strings(), step)

    words = F.array_join(_text_words(body), " ")
    if few:
        # many labels have the same terms: each of them is looked for once, before the labels are gone through
        every = each.agg(F.collect_set("term")).scalar()
        held = F.array(F.struct(words.alias("body"), F.col("_terms").alias("table"), F.col("_every").alias("every")))
        bound = F.transform(held, lambda r: F.struct(r["table"].alias("table"), F.filter(r["every"], lambda t: F.contains(r["body"], t)).alias("known")))
        return df.withColumn("_terms", table).withColumn("_every", every).withColumn(out, F.transform(bound, first_k)[0]).drop("_terms", "_every")
    # the one-element array binds the words of the text once per record
    bound = F.array(F.struct(words.alias("body"), F.col("_terms").alias("table")))
    return df.withColumn("_terms", table).withColumn(out, F.transform(bound, first_k)[0]).drop("_terms")


def _blocks(terms: DataFrame, bound: int | None) -> Iterator[list]:
    """The term table in taxonomy order, in runs of labels whose terms take about ``bound`` bytes; a
    single label may take more. Each run is collected when its pass is planned."""
    if bound is None:
        yield terms.orderBy("pos", "label").select("label", "terms").collect()
        return
    size = F.octet_length("label") + F.aggregate("terms", F.lit(0), lambda n, t: n + F.octet_length(t))
    rows = numbered(terms.select("label", "terms", "pos", size.cast("bigint").alias("_size")), [F.col("pos").asc(), F.col("label").asc()], "_at")
    n = rows.count()
    step = max(1, n)
    while step > 1:
        worst = rows.groupBy(F.floor(F.col("_at") / step)).agg(F.sum("_size").alias("s")).agg(F.max("s")).first()[0]
        if worst <= bound:
            break
        step = -(-step // 2)
    for first in range(0, max(1, n), step):
        run = rows.filter((F.col("_at") >= first) & (F.col("_at") < first + step))
        yield run.orderBy("_at").select("label", "terms").collect()


def _matcher(words: list[str]):
    """The function from a text to the numbers of the words that stand in it."""
    if not words:
        return lambda text: set()
    try:
        import ahocorasick
    except ImportError:
        return lambda text: {i for i, w in enumerate(words) if w in text}
    machine = ahocorasick.Automaton()
    for number, word in enumerate(words):
        machine.add_word(word, number)
    machine.make_automaton()
    return lambda text: {number for _, number in machine.iter(text)}


_FOUND = "array<struct<score:int,place:bigint,label:string>>"


def _first(own: list[list[int]], found: set[int], k: int) -> list[tuple[int, int]]:
    """The first ``k`` labels; only the first ``k`` of a term can be among them."""
    return [(0, i) for i in sorted(set().union(*[own[t][:k] for t in found]))[:k]]


def _most(own: list[list[int]], found: set[int], k: int) -> list[tuple[int, int]]:
    """The ``k`` labels with most terms found, the first of equals."""
    count = Counter(i for t in found for i in own[t])
    return sorted((-n, i) for i, n in count.items())[:k]


def _by_blocks(df: DataFrame, body: Column, terms: DataFrame, k: int, out: str, pick, bound: int | None) -> DataFrame:
    """A multi-pattern matcher per block of labels; ``pick`` scores a text's labels of the block.

    A single block is matched in the row, as are all blocks of a stream, with the best ``k`` so far carried
    along. Several blocks of a table are passes over the numbered records, written once: each pass
    writes what it found, ``k`` labels of a record at most, and the best ``k`` of all are joined back.
    """
    runs = _blocks(terms, bound)
    first, second = next(runs), next(runs, None)
    if second is not None and not df.isStreaming:
        return _by_passes(df, body, chain([first, second], runs), k, out, pick)
    base, best, done = df.withColumn("_text_words", _text_words(body)), F.array().cast(_FOUND), 0
    for run in chain([first], [] if second is None else [second], runs):
        found = F.arrow_udf(_scan(df.sparkSession, run, done, k, pick)[0], _FOUND)
        # in taxonomy order a text that has k labels needs no further block
        full = (F.size(best) >= k) if pick is _first else F.lit(False)
        new = F.coalesce(found(F.when(~full, F.col("_text_words"))), F.array().cast(_FOUND))
        best = F.slice(F.array_sort(F.concat(best, new)), 1, k)
        done += len(run)
    return base.withColumn("_found_so_far", best).withColumn(out, F.transform("_found_so_far", lambda s: s["label"])).drop("_text_words", "_found_so_far")


def _by_passes(df: DataFrame, body: Column, runs: Iterable[list], k: int, out: str, pick) -> DataFrame:
    spark, row, done, due = df.sparkSession, "_match_row", 0, 1
    rows = row_keyed(df, row)
    left = written(rows.select(row, _text_words(body).alias("_words")).filter("_words IS NOT NULL"), "text_words")
    path = fresh_path(spark, "keywords")
    for number, run in enumerate(runs):
        if number == due and pick is _first:
            # in taxonomy order a text that has k labels needs no further block
            due *= 2
            full = spark.read.schema(hits.schema).parquet(path).groupBy(row).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= k)
            left = written(left.join(full, row, "left_anti"), "text_words")
        match, shared = _scan(spark, run, done, k, pick)
        hits = left.select(row, F.explode(F.arrow_udf(match, _FOUND)("_words")).alias("hit"))
        hits.write.parquet(f"{path}/block={number}")
        shared.destroy()
        done += len(run)
    found = spark.read.schema(hits.schema).parquet(path)
    best = found.groupBy(row).agg(F.slice(F.array_sort(F.collect_list("hit")), 1, k).alias("_found"))
    names = F.transform("_found", lambda s: s["label"])
    return rows.join(best, row, "left").withColumn(out, F.coalesce(names, empty_strings())).drop(row, "_found")


def _scan(spark, rows: list, place: int, k: int, pick):
    """The function that finds the labels of ``rows`` in batches of texts, and the broadcast that it reads."""
    names = [r["label"] for r in rows]
    owners: dict[str, list[int]] = {}
    for i, r in enumerate(rows):
        for term in r["terms"]:
            owners.setdefault(term, []).append(i)
    shared = spark.sparkContext.broadcast((names, list(owners), list(owners.values())))

    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, words, own = shared.value
        find, names = _matcher(words), pa.array(names, pa.string())
        remembered = lru_cache(KNOWN_WORDS)(lambda word: tuple(find(word)))
        for lists in batches:
            yield pa.concat_arrays([_labels_of(run, find, remembered, own, names, place, k, pick) for run in _text_runs(lists)])

    return match, shared


def _text_runs(lists: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about ``RUN_WORDS`` words, one text at least; of no texts one empty run."""
    ends = np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(lists) or not len(lists):
        last = max(first + 1, int(np.searchsorted(ends, RUN_WORDS + (ends[first - 1] if first else 0), "right")))
        yield lists.slice(first, last - first)
        first = last
        if not len(lists):
            break


def _labels_of(lists: pa.Array, find, remembered, own: list[list[int]], names: pa.Array, place: int, k: int, pick) -> pa.Array:
    """The labels of the texts whose distinct words are given; NULL has none."""
    lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    terms = [remembered(w) if len(w) <= LONG_WORD else find(w) for w in coded.dictionary.to_pylist()]
    code = coded.indices.to_numpy(zero_copy_only=False)
    some = np.fromiter(map(bool, terms), bool, len(terms))[code]
    text, code = np.repeat(np.arange(len(lists)), lengths)[some], code[some].tolist()
    cuts = np.searchsorted(text, np.arange(len(lists) + 1)).tolist()
    picked = [pick(own, set().union(*[terms[c] for c in code[i:j]]), k) if i < j else [] for i, j in zip(cuts, cuts[1:])]
    flat = np.array([x for one in picked for x in one], np.int64).reshape(-1, 2)
    found = pa.StructArray.from_arrays(
        [pa.array(flat[:, 0].astype(np.int32)), pa.array(place + flat[:, 1]), names.take(pa.array(flat[:, 1]))], ["score", "place", "label"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, picked)]), pa.int32()), found)


def term_overlap(
    df: DataFrame, text: str, labels: DataFrame, k: int = 5, *, out: str = "labels", form: str = "auto",
) -> DataFrame:
    """The ``k`` labels with most distinct terms contained in the text; ties in taxonomy order."""
    terms = label_terms(labels).select("label", "pos", "terms")
    form = _choose(terms) if form == "auto" else form
    body = F.lower(F.col(text))
    if form != "inline":
        return _by_blocks(df, body, terms, k, out, _most, bound=None if form == "automaton" else setting(df.sparkSession, "broadcastBytes"))
    table = terms.agg(F.array_sort(F.collect_list(F.struct("pos", "label", "terms")))).scalar()

    def best(row: Column) -> Column:
        scored = F.transform(
            row["table"],
            lambda e, i: F.struct(
                (-F.size(F.filter(e["terms"], lambda t: F.contains(row["body"], t)))).alias("s"),
                i.alias("i"), e["label"].alias("label"),
            ),
        )
        hit = F.filter(scored, lambda s: s["s"] < 0)
        return F.transform(F.slice(F.array_sort(hit), 1, k), lambda s: s["label"])

    bound = F.array(F.struct(F.array_join(_text_words(body), " ").alias("body"), F.col("_terms").alias("table")))
    found = df.withColumn("_terms", table).withColumn(out, F.transform(bound, best)[0]).drop("_terms")
    return found.withColumn(out, F.coalesce(F.col(out), empty_strings()))
