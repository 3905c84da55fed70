"""Language identification, words first: known words count by their log frequency in each language,
unseen words by their character n-grams, the longest length of which any is known.

The model is fitted on a bounded sample of the labelled rows; every table of it is bounded too, so
it can be held by each task. Prediction reads whole texts in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import written
from .batches import Memo, map_text, slices

FIT_ROWS = 20_000  # labelled rows the model is fitted on, about, at most; an equal part for each language
MAX_WORDS, MAX_GRAMS = 200_000, 200_000  # rows of the model's tables, an equal part for each language,
MAX_CELLS = 16_000_000  # and their rows times languages: with more than 80 languages the tables have fewer rows
LONGEST = 5  # characters of the longest n-gram; ^ and $ mark the ends of a word
SMOOTHING = 0.5


def words_of(texts: pa.Array) -> pa.ListArray:
    """Lower-case runs of letters and marks of each text; a list of one empty word if there are none."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts.cast(pa.string()).fill_null("")), r"[^\p{L}\p{M}]+", " ")
    return pc.split_pattern(pc.utf8_trim(plain, " "), " ")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(parts))


def sampled(df: DataFrame, rows: int, *key: str) -> DataFrame:
    """``df`` if it has no more than ``rows`` rows, else about so many of them by a hash of ``key``."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(11), *key), F.lit(1 << 30)) < int((1 << 30) * rows / n))


def sampled_by(df: DataFrame, rows: int, group: str, *key: str) -> DataFrame:
    """About ``rows`` rows, by a hash of ``key``: of each group all, or an equal part of them. One
    row per group is broadcast: groups are languages here."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    part = rows / max(1, sizes.count())
    rate = F.lit(part * (1 << 30)) / F.col("_n")
    return df.join(F.broadcast(sizes), group).filter(F.pmod(F.xxhash64(F.lit(11), *key), F.lit(1 << 30)) < rate).drop("_n")


class Model:
    """Log frequencies by language: of words, and of n-grams by length."""

    def __init__(self, langs: list[str], words: list[str], word_counts: np.ndarray, grams: list[str], gram_counts: np.ndarray):
        self.langs, self.words = langs, pa.array(words, pa.string())
        self.word_logs = self._logs(word_counts)
        sizes = np.array([len(g) for g in grams], np.int64)
        self.gram_logs = np.zeros_like(gram_counts, dtype=np.float64)
        for n in np.unique(sizes):
            self.gram_logs[sizes == n] = self._logs(gram_counts[sizes == n])
        self.place = {g: i for i, g in enumerate(grams)}

    @staticmethod
    def _logs(counts: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.float64)
        return np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0, keepdims=True) + SMOOTHING * (len(counts) + 1))

    def unseen(self, word: str) -> np.ndarray:
        """Mean log frequency of the word's known n-grams of the longest length that has any; else zeros."""
        marked, place = f"^{word}$", self.place
        for n in range(min(LONGEST, len(marked)), 0, -1):
            known = [k for i in range(len(marked) - n + 1) if (k := place.get(marked[i:i + n])) is not None]
            if known:
                logs = (self.gram_logs[known[a:a + 4096]].sum(axis=0) for a in range(0, len(known), 4096))  # a word may be very long
                return sum(logs) / len(known)
        return np.zeros(len(self.langs))

    def predict(self, texts: pa.Array, memo: Memo) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its posterior under equal priors; ``und`` and 0 without a letter."""
        n = len(self.langs)
        if not n:
            return ["und"] * len(texts), np.zeros(len(texts))
        lists = words_of(texts)
        words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        codes = pc.index_in(words, self.words).fill_null(-1).to_numpy()
        scores = np.zeros((len(texts), n))
        owner = np.repeat(np.arange(len(texts)), np.diff(ends))
        known = np.flatnonzero(codes >= 0)
        odd = np.flatnonzero(codes < 0)
        coded = words.take(pa.array(odd)).dictionary_encode()
        logs = np.array([memo[w] if w else np.zeros(n) for w in coded.dictionary.to_pylist()]).reshape(-1, n)
        for lang in range(n):
            scores[:, lang] = np.bincount(owner[known], self.word_logs[codes[known], lang], len(texts))
            scores[:, lang] += np.bincount(owner[odd], logs[coded.indices.to_numpy(), lang], len(texts))
        odds = np.exp(scores - scores.max(axis=1, keepdims=True))
        best = scores.argmax(axis=1)
        letters = pc.match_substring_regex(texts.cast(pa.string()).fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        sure = np.where(letters, 1 / odds.sum(axis=1), 0.0)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, letters)], sure


def fit(df: DataFrame, text: str = "text", lang: str = "lang", rows: int = FIT_ROWS, key: str = "doc_id") -> Model:
    """Learn from the rows whose ``lang`` is not null, or from a hash sample of about ``rows`` of them, an equal
    part for each language (all rows of a language with fewer).

    Words and n-grams are counted in Spark; the most frequent ones of each language, bounded in number, and no
    other part of the table reach the driver. Every language that a row with a word has is learned. Rows with
    null or empty texts teach nothing. Without labelled rows the model knows no language and predicts ``und``.
    """
    some = sampled_by(df.filter(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text")), rows, "lang", "key")
    some = some.select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, 1):
                lists = words_of(b.column(1))
                table = pa.table({"lang": b.column(0).take(pc.list_parent_indices(lists)), "word": lists.flatten()})
                sums = table.filter(pc.not_equal(table["word"], "")).group_by(["lang", "word"]).aggregate([([], "count_all")])
                yield from sums.select(["lang", "word", "count_all"]).rename_columns(["lang", "word", "n"]).to_batches()

    counted = some.mapInArrow(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = written(counted, "words")
    # the commonest language first: it wins where nothing tells languages apart
    sizes = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").collect()  # a row per language
    langs = [r["lang"] for r in sizes]
    if not langs:
        return Model([], [], np.zeros((0, 0)), [], np.zeros((0, 0)))
    number = {lang: i for i, lang in enumerate(langs)}

    def top(df: DataFrame, name: str, most: int) -> tuple[list[str], np.ndarray]:
        each = max(1, min(most, MAX_CELLS // len(langs)) // len(langs))
        sums = written(df.groupBy("lang", name).agg(F.sum("n").alias("n")), "sums")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), name))
        kept = sums.withColumn("rank", rank).filter(F.col("rank") <= each).select(name).distinct()
        table = sums.join(kept, name, "left_semi").select("lang", name, "n").toArrow()
        coded = table.column(name).combine_chunks().dictionary_encode()
        counts = np.zeros((len(coded.dictionary), len(langs)))
        counts[coded.indices.to_numpy(), [number[lang] for lang in table.column("lang").to_pylist()]] = table.column("n").to_numpy()
        return coded.dictionary.to_pylist(), counts

    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    grams = F.flatten(F.array(*(
        F.when(F.char_length(marked) >= n, F.transform(F.sequence(F.lit(1), F.char_length(marked) - n + 1), _cut(marked, n))).otherwise(F.array().cast("array<string>"))
        for n in range(1, LONGEST + 1))))
    return Model(langs, *top(counted, "word", MAX_WORDS), *top(counted.select("lang", "n", F.explode(grams).alias("gram")), "gram", MAX_GRAMS))


def _cut(word: Column, n: int):
    return lambda i: F.substring(word, i, F.lit(n))


def identify(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The columns of ``df`` but ``text``, with ``lang_pred`` and ``score``; such columns are replaced.
    Every whole text is read. Null, empty and letterless texts are ``und`` with score 0; ties go to the
    language with more words in the sample; an empty table gives an empty result."""

    def start():
        memo = Memo(model.unseen, 200_000)

        def make(texts: pa.Array) -> list[pa.Array]:
            langs, sure = model.predict(texts, memo)
            return [pa.array(langs, pa.string()), pa.array(sure, pa.float64())]

        return make

    return map_text(df, text, {"lang_pred": "string", "score": "double"}, start)
