"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated.

The features approximate a Gaussian kernel over standardised statistics. Every task sums its part of
the normal equations, Spark sums the parts by row, and the driver solves a system whose size is
fixed. Scores are calibrated by isotonic regression on labelled rows that the ridge has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written
from .batches import map_text, nullable, utf8, word_lists
from .langid import sampled

FIT_ROWS = 20_000  # labelled documents the model is fitted on, about, at most
FEATURES, LENGTH, RIDGE, SEED = 256, 3.0, 1.0, 17  # random features, kernel width, penalty
BINS = 4096  # of the raw score, for the calibration
STATISTICS = 16
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
STOPS, MARKS, SYMBOLS = b".?!", b",;:'\"()-", b"#*$%&<>@=+/\\^_~{}[]"


def statistics(text: bytes) -> list[float]:
    """Fixed numbers about a whole text; all zero for the empty one."""
    n = len(text)
    if not n:
        return [0.0] * STATISTICS
    words = chars = same = marked = capital = longest = run = 0
    distinct: set[bytes] = set()
    before = [b""]
    for part in word_lists(text):
        words += len(part)
        chars += sum(map(len, part))
        equal = list(map(eq, before + part[:-1], part))
        same += sum(equal)
        for e in equal if any(equal) else ():
            run = run + 1 if e else 0
            longest = max(longest, run)
        marked += sum(w[-1] in b".,;:!?" for w in part)
        capital += sum(map(bytes.isupper, part))
        distinct.update(part)
        before = part[-1:]
    share = lambda kind: (n - len(text.translate(None, kind))) / n
    lines = [x for x in text.split(b"\n") if x.strip()]
    w = max(1, words)
    return [
        np.log1p(words), chars / w, share(UPPER), share(DIGITS), share(STOPS), share(MARKS), share(SYMBOLS), share(b"!"), share(b"|"),
        len(distinct) / w, same / w, np.log1p(longest), marked / w, capital / w,
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(words / max(1, len(lines))),
    ]


def with_statistics(df: DataFrame, text: str = "text", column: str = "stats") -> DataFrame:
    """The columns of ``df`` but ``text``, and an array of statistics. Null counts as the empty text."""

    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([statistics(t) for t in utf8(texts)], pa.list_(pa.float64()))]

    return map_text(df, text, {column: "array<double>"}, lambda: make)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, STATISTICS)


class Model:
    """Centre and spread of the statistics, random features, ridge weights, calibration points."""

    def __init__(self, centre: np.ndarray, spread: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.centre, self.spread = centre, np.where(spread > 1e-9, spread, 1.0)
        self.wave = rng.normal(0, 1 / LENGTH, (STATISTICS, FEATURES))
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.raw, self.share = np.array([0.0, 1.0]), np.array([0.5, 0.5])

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.centre) / self.spread, -6, 6)
        return np.hstack([np.cos(z @ self.wave + self.phase) * np.sqrt(2 / FEATURES), np.ones((len(z), 1))])

    def raw_score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.features(stats) @ self.weights, -0.5, 1.5)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probability of label 1. A thousandth of it follows the raw score, so that the flat
        steps of the calibration keep their order."""
        raw = self.raw_score(stats)
        return 0.999 * np.interp(raw, self.raw, self.share) + 0.001 * (raw + 0.5) / 2


def isotonic(x: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising shares of ones by pooling neighbours that fall; both ends of each pool are returned."""
    pools: list[list[float]] = []  # first x, last x, total, ones
    for a, n, k in sorted(zip(x.tolist(), total.tolist(), ones.tolist())):
        pools.append([a, a, n, k])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, last, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0], last, pools[-1][2] + n2, pools[-1][3] + k2]
    return np.array([e for p in pools for e in p[:2]]), np.array([p[3] / p[2] for p in pools for _ in (0, 1)])


def fit(labelled: DataFrame, stats: str = "stats", label: str = "label", calibrate: str = "calibrate") -> Model:
    """Fit on rows with an array of statistics and a 0/1 label; rows with a true ``calibrate`` serve the
    calibration only. The driver gets one row of centres, a row per feature of the summed equations,
    and a bounded number of score bins. Without rows the score is 0.5, without rows to calibrate on
    the raw score counts; a single label gives its share everywhere."""
    train = labelled.filter(~F.col(calibrate))
    at = [F.col(stats)[i] for i in range(STATISTICS)]
    row = train.agg(F.count(F.lit(1)).alias("n"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(at)), *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(at))).first()
    if not row["n"]:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS))
    model = Model(*(np.array([row[f"{k}{i}"] for i in range(STATISTICS)]) for k in "ms"))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FEATURES + 1, FEATURES + 2))
        for b in batches:
            x, y = model.features(matrix(b.column(0))), b.column(1).to_numpy()
            sums += x.T @ np.hstack([x, y[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums))), pa.array(list(sums))], ["i", "sums"])

    def whole(table: pa.Table) -> pa.Table:
        rows = table.column("sums").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        return pa.table({"i": table.column("i")[:1], "sums": pa.array([rows.sum(axis=0)])})

    kind = "i bigint, sums array<double>"
    parts = train.select(stats, F.col(label).cast("double")).mapInArrow(part, kind)
    sums = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in parts.groupBy("i").applyInArrow(whole, kind).collect():
        sums[r["i"]] = r["sums"]
    penalty = RIDGE * np.eye(FEATURES + 1)
    penalty[-1, -1] = 1e-9  # the constant is free
    model.weights = np.linalg.solve(sums[:, :-1] + penalty, sums[:, -1])

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = np.rint((model.raw_score(matrix(b.column(0))) + 0.5) / 2 * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), b.column(1)], ["bin", "label"])

    binned = labelled.filter(F.col(calibrate)).select(stats, F.col(label).cast("double")).mapInArrow(raw, "bin bigint, label double")
    points = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")).collect()
    if points:
        x = np.array([r["bin"] for r in points]) / BINS * 2 - 0.5
        model.raw, model.share = isotonic(x, np.array([r["n"] for r in points]), np.array([r["ones"] for r in points]))
    else:
        model.raw, model.share = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(df: DataFrame, model: Model, stats: str = "stats") -> DataFrame:
    """The columns of ``df`` but ``stats``, with ``score`` between 0 and 1; such a column is replaced."""
    kept = [c for c in df.columns if c not in (stats, "score")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.clip(model.score(matrix(b.column(len(kept)))), 0, 1)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(values, pa.float64())], [*kept, "score"])

    names = [f"`{c}`" for c in kept]
    schema = df.select(*names, F.lit(0.0).alias("score")).schema
    return df.select(*names, f"`{stats}`").mapInArrow(run, nullable(schema))


def fit_and_score(
    docs: DataFrame, labels: DataFrame, held_out, calibrate, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: its id and ``score``. ``held_out`` and ``calibrate`` map the id column
    to a condition: labels of held-out ids are never read.

    A document's label is the mean of its non-null labels; labels of unknown documents are ignored.
    Statistics are made once per document and written; the labels, or a hash sample of about ``rows``
    of them and never twice as many, are sent to them. Repeated rows get equal scores.
    """
    stats = written(with_statistics(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))), "statistics")
    known = labels.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{label}`").cast("double").alias("label")).filter("label IS NOT NULL AND id IS NOT NULL")
    known = known.filter(~held_out(F.col("id"))).groupBy("id").agg(F.avg("label").alias("label"))
    known = sampled(known, rows, "id").limit(2 * rows)
    train = stats.join(F.broadcast(known), "id").select("stats", "label", calibrate(F.col("id")).alias("calibrate"))
    model = fit(written(train, "labelled"))
    return score(stats, model).withColumnRenamed("id", doc_id)
