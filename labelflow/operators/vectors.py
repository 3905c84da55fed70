"""Text vectors and deterministic clustering."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import sample_order, words
from ..settings import written

__all__ = [
    "bucket_words", "bucket_weights", "weight_vector", "embed_text", "Centres", "Clustering", "seed_parallel", "fit_centres", "fit_clusters",
    "cluster_vectors", "cluster_ml", "assign_clusters",
]

# 1.0 in fixed point. Products of two such numbers, summed over up to 2**20 dimensions, stay below
# 2**53, so float64 arithmetic on them is exact in any order.
UNIT = 1 << 16

RUN_WORDS = 1 << 20  # words whose places are held at a time


def bucket_words(text: str | Column, dim: int) -> Column:
    """Hash bucket of every word of the text (repeats stay)."""
    def bucket(word: Column) -> Column:
        head = F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("bigint")
        return (head % dim).cast("int")

    return F.transform(words(text), bucket)


def bucket_weights(df: DataFrame, text: str, dim: int, buckets: str | None = None) -> DataFrame:
    """Inverse document frequency of each bucket: ``(bucket, weight)``, ``dim`` rows at most.

    Every task sends one row per bucket, so the shuffle does not grow with the texts. ``buckets`` names
    a stored column of ``bucket_words``; then the texts are not read.
    """
    hashed = F.col(buckets) if buckets else bucket_words(text, dim)
    hit = df.select(F.explode(F.array_distinct(hashed)).alias("bucket"))
    total = df.agg(F.count(F.lit(1))).scalar()
    seen = hit.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return seen.select("bucket", F.log((total + 1.0) / (F.col("n") + 1.0)).alias("weight"))


def weight_vector(df: DataFrame, text: str, dim: int, buckets: str | None = None) -> np.ndarray:
    """The bucket weights as one array; runs a job that returns ``dim`` rows at most."""
    weights = np.zeros(dim)
    table = bucket_weights(df, text, dim, buckets).toPandas()
    weights[table["bucket"].to_numpy(np.int64)] = table["weight"].to_numpy()
    return weights


def embed_text(
    df: DataFrame, text: str, dim: int = 64, out: str = "vector", weights: np.ndarray | None = None, buckets: str | None = None,
) -> DataFrame:
    """Attach a unit-length hashed TF-IDF vector of the whole text; a text without words gets zeros.

    ``weights`` come from the same texts unless given, so labels can be embedded with the weights
    of the records. The rows are not shuffled: words are hashed in the JVM and counted per Arrow
    batch. Both passes over the texts hash their words; a written table may hold ``bucket_words`` in a
    column ``buckets``, so that they are hashed once.
    """
    idf = weight_vector(df, text, dim, buckets) if weights is None else weights

    def embed(rows: pa.Array) -> pa.Array:
        lengths = rows.value_lengths().to_numpy()
        ends = np.cumsum(lengths, dtype=np.int64)
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        out = np.empty((len(rows), dim), np.float32)
        first = done = 0
        while first < len(rows):  # runs of rows with so many words that their numbers are small
            last = max(first + 1, int(np.searchsorted(ends, done + RUN_WORDS, "right")))
            last = min(last, first + max(1, RUN_WORDS // dim))
            place = np.repeat(np.arange(last - first, dtype=np.int64) * dim, lengths[first:last]) + flat[done:ends[last - 1]]
            grid = np.bincount(place, minlength=(last - first) * dim).reshape(last - first, dim) * idf
            norm = np.sqrt((grid * grid).sum(axis=1, keepdims=True))
            out[first:last] = grid / np.where(norm > 0, norm, 1.0)
            first, done = last, int(ends[last - 1])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dim), pa.array(out.ravel()))

    hashed = F.coalesce(F.col(buckets) if buckets else bucket_words(text, dim), F.array().cast("array<int>"))
    return df.withColumn(out, F.arrow_udf(embed, T.ArrayType(T.FloatType()))(hashed))


# -- clustering -------------------------------------------------------------------------------

def _fixed(vectors: pd.Series) -> np.ndarray:
    return np.rint(np.stack(vectors.map(lambda v: np.asarray(v, dtype=np.float64)).to_list()) * UNIT)


def _whole(vectors: pa.Array) -> np.ndarray:
    """As :func:`_fixed`, from the lists as they come."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.rint(flat.reshape(len(vectors), -1) * UNIT)


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Index of the nearest centre, the first on ties. All numbers are whole, so this is exact."""
    return np.argmin((centres * centres).sum(axis=1) - 2.0 * (points @ centres.T), axis=1)


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centres: whole numbers."""
    return (points * points).sum(axis=1)[:, None] + (centres * centres).sum(axis=1) - 2.0 * (points @ centres.T)


def _seed_centres(df: DataFrame, key: str, vector: str, k: int, seed: int) -> np.ndarray:
    rows = df.select(vector, sample_order(key, seed).alias("_o"), key).orderBy("_o", key).limit(k).toPandas()
    return _fixed(rows[vector]) if len(rows) else np.zeros((0, 0))


def _sums(points: DataFrame, vector: str, centres: np.ndarray) -> tuple[int, np.ndarray]:
    """The sum of squared distances to the nearest centre, and how many points each centre is nearest to."""
    k = len(centres)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, counts = 0, np.zeros(k, np.int64)
        for batch in batches:
            if len(batch):
                far = _squares(_fixed(batch[vector]), centres)
                own = far.argmin(axis=1)
                total += int(far[np.arange(len(own)), own].sum())
                counts += np.bincount(own, minlength=k)
        yield pd.DataFrame({"c": [-2, -1, *range(k)], "n": [total >> 32, total & 0xFFFFFFFF, *counts]})

    rows = points.select(vector).mapInPandas(partial, "c int, n long").groupBy("c").agg(F.sum("n").alias("n")).collect()  # a row per centre
    got = {r["c"]: r["n"] for r in rows}
    return (got.get(-2, 0) << 32) + got.get(-1, 0), np.array([got.get(c, 0) for c in range(k)])


def seed_parallel(df: DataFrame, key: str, vector: str, k: int, *, seed: int = 42, rounds: int = 4, oversampling: int = 2) -> np.ndarray:
    """``k`` starting centres by k-means||: far apart, and in dense places.

    Starts with one row. In each round a row becomes a candidate with a chance of ``oversampling * k`` times its
    share of the squared distances to the candidates so far; chances are hashes of the key, so the result does not
    depend on the partitioning. Candidates are weighted by the rows that are nearest to them, and ``k`` are picked:
    the heaviest, then always the one of largest weight times squared distance. The driver sees
    about ``oversampling * k * rounds`` vectors. Fewer than ``k`` different vectors give fewer centres.
    """
    points = df.filter(F.col(vector).isNotNull()).select(key, vector)
    found = _seed_centres(points, key, vector, 1, seed)
    for n in range(rounds if len(found) else 0):
        total, _ = _sums(points, vector, found)
        if not total:
            break
        wanted = float(oversampling * k) / total

        def draw(batches: Iterator[pd.DataFrame], centres: np.ndarray = found, wanted: float = wanted) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    x = _fixed(batch[vector])
                    far = _squares(x, centres).min(axis=1)
                    picked = batch["_u"].to_numpy() / float(1 << 30) < far * wanted
                    if picked.any():
                        yield pd.DataFrame({"x": x[picked].tolist()})

        chance = F.pmod(F.xxhash64(F.lit(seed), F.lit(n), key), F.lit(1 << 30))
        drawn = points.select(vector, chance.alias("_u")).mapInPandas(draw, "x array<double>").toPandas()
        if len(drawn):
            found = np.unique(np.vstack([found, np.stack(drawn["x"].map(np.asarray).to_list())]), axis=0)
    if len(found) <= k:
        return found
    weight = _sums(points, vector, found)[1].astype(np.float64)
    picked = [int(weight.argmax())]
    far = _squares(found, found[picked])[:, 0]
    while len(picked) < k and (weight * far).max() > 0:
        picked.append(int((weight * far).argmax()))
        far = np.minimum(far, _squares(found, found[picked[-1:]])[:, 0])
    return found[picked]


class Centres(NamedTuple):
    points: np.ndarray
    rounds: int
    converged: bool


class Clustering(NamedTuple):
    rows: DataFrame
    centres: np.ndarray
    rounds: int
    converged: bool


GUESS_FROM = 32  # centres from which on rows carry a guess, and
GUESS_AFTER = 2  # rounds until it is made
REST = 300  # rounds at most, unless fewer are asked for


def fit_centres(
    df: DataFrame, key: str, vector: str, k: int, *, seed: int = 42, iterations: int = REST, start: str | np.ndarray = "hash",
) -> Centres:
    """Centres of K-means that do not depend on the partitioning.

    Starts from ``k`` rows in seeded hash order, with ``parallel`` from those of :func:`seed_parallel`, or from
    given centres (whole numbers, ``UNIT`` times the coordinates). Each round sends ``k`` times ``dim`` whole-number
    sums per task; only these ``k`` times ``dim`` totals reach the driver. A centre that no row is nearest to moves to
    the row that is farthest from its own. Vectors should have unit length. Rounds re-read ``df``, so hand in a
    written table (see ``write_index``). Ends when no centre moves, or after ``iterations`` rounds: then the result
    says that it did not converge, and a warning is logged unless the caller set the number of rounds.

    With many centres the rows are written with a guess after some rounds. A row that is nearer to its guess than half
    the way to any other centre is not compared with the others.
    """
    points = df.filter(F.col(vector).isNotNull()).select(key, vector)
    if isinstance(start, np.ndarray):
        centres = start
    else:
        centres = (seed_parallel if start == "parallel" else _seed_centres)(points, key, vector, k, seed=seed)
    guess = None
    for n in range(iterations if len(centres) else 0):
        if n == GUESS_AFTER and len(centres) >= GUESS_FROM:
            guess = "_guess"
            points = written(assign_clusters(points, vector, centres, guess), "guessed")
        moved, empty = _move(points, vector, centres, guess)
        if len(empty):
            moved = _seed_again(points, key, vector, moved, empty)
        if np.array_equal(moved, centres):
            return Centres(centres, n + 1, True)
        centres = moved
    if len(centres) and iterations >= REST:
        logging.getLogger(__name__).warning("the centres still move after %d rounds", iterations)
    return Centres(centres, iterations, not len(centres))


def _seed_again(points: DataFrame, key: str, vector: str, centres: np.ndarray, empty: np.ndarray) -> np.ndarray:
    """Move the centres without rows to the rows farthest from all centres (ties by hash of the key)."""

    def far(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = _fixed(batch[vector])
                d = _squares(x, centres).min(axis=1)
                last = np.lexsort((batch["_h"].to_numpy(), -d))[: len(empty)]
                yield pd.DataFrame({"d": d[last], "h": batch["_h"].to_numpy()[last], "x": x[last].tolist()})

    rows = points.select(vector, F.xxhash64(key).alias("_h")).mapInPandas(far, "d double, h long, x array<double>")
    best = rows.filter("d > 0").orderBy(F.col("d").desc(), "h", "x").limit(len(empty)).toPandas()
    out = centres.copy()
    for c, x in zip(empty, best["x"]):
        out[c] = np.asarray(x)
    return out


def fit_clusters(df: DataFrame, key: str, vector: str, k: int, *, out: str = "cluster_id", **options) -> Clustering:
    """:func:`fit_centres`, and the rows with their nearest centre. NULL vectors get cluster -1."""
    fitted = fit_centres(df, key, vector, k, **options)
    return Clustering(assign_clusters(df, vector, fitted.points, out), *fitted)


def cluster_vectors(
    df: DataFrame, key: str, vector: str, k: int, *, seed: int = 42, iterations: int = REST, out: str = "cluster_id"
) -> DataFrame:
    """Attach the nearest centre of :func:`fit_centres`. NULL vectors get cluster -1."""
    return fit_clusters(df, key, vector, k, seed=seed, iterations=iterations, out=out).rows


def _move(points: DataFrame, vector: str, centres: np.ndarray, guess: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The means of the rows nearest to each centre, and the centres without rows."""
    k, dim = centres.shape
    between = _squares(centres, centres)
    np.fill_diagonal(between, np.inf)
    gap = between.min(axis=1)  # squared way to the next centre

    def nearest(batch: pa.RecordBatch, x: np.ndarray) -> np.ndarray:
        if guess is None:
            return _nearest(x, centres)
        own = batch.column(1).to_numpy().astype(np.int64)
        open_ = np.flatnonzero(4 * ((x - centres[own]) ** 2).sum(axis=1) >= gap[own])
        own[open_] = _nearest(x[open_], centres)
        return own

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim), dtype=np.int64)
        counts = np.zeros(k, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch.column(0))
                own = nearest(batch, x)
                order = np.argsort(own, kind="stable")
                mine, first = np.unique(own[order], return_index=True)
                sums[mine] += np.add.reduceat(x[order].astype(np.int64), first, axis=0)
                counts += np.bincount(own, minlength=k)
        used = np.flatnonzero(counts)
        if len(used):
            told = np.column_stack([sums, counts])[used]
            cuts = pa.array(np.arange(len(used) + 1, dtype=np.int32) * (dim + 1))
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.ListArray.from_arrays(cuts, pa.array(told.ravel()))], ["c", "s"])

    rows = points.select(vector, *([guess] if guess else []))
    cells = rows.mapInArrow(partial, "c int, s array<long>").select("c", F.posexplode("s").alias("d", "v"))
    totals = cells.groupBy("c", "d").agg(F.sum("v").alias("v")).toPandas()  # k * (dim + 1) rows at most
    grid = np.zeros((k, dim + 1))
    grid[totals["c"], totals["d"]] = totals["v"]
    size = grid[:, dim:]
    return np.where(size > 0, np.floor(grid[:, :dim] / np.maximum(size, 1) + 0.5), centres), np.flatnonzero(size[:, 0] == 0)


def assign_clusters(df: DataFrame, vector: str, centres: np.ndarray, out: str = "cluster_id") -> DataFrame:
    """Attach the nearest centre, in the row. NULL vectors, and all if there is no centre, get -1."""
    if len(centres) == 0:
        return df.withColumn(out, F.lit(-1))

    def nearest(vectors: pd.Series) -> pd.Series:
        known = vectors.notna()
        ids = np.full(len(vectors), -1, dtype=np.int32)
        if known.any():
            ids[known.to_numpy()] = _nearest(_fixed(vectors[known]), centres)
        return pd.Series(ids)

    return df.withColumn(out, F.pandas_udf(nearest, T.IntegerType())(vector))


def cluster_ml(df: DataFrame, vector: str, k: int, *, seed: int = 42, iterations: int = 10, out: str = "cluster_id") -> DataFrame:
    """Spark ML k-means: fast, but its clusters depend on the partitioning."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    known = df.withColumn("_v", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="_v", predictionCol=out).fit(known)
    return model.transform(known).drop("_v")
