"""Top-k similarity join: for each record the ``k`` nearest labels by cosine, with scores.

Scores are rounded to six digits and ties are broken by label name, so results do not depend on
the order of floating-point sums. Forms, chosen by the measured size of the label side:

* ``broadcast`` label table within the bound: block products per Arrow batch, no shuffle; the lists
                stay in the record's row
* ``cells``     both sides large: the labels lie in an inverted file (see ``cells``), and a record
                looks at the cells that may hold one of its best. Exact; an index stored by
                ``write_index`` is read instead of built
* ``grid``      records and labels are cut into bounded blocks, every pair of blocks is one task
                that keeps the best ``k`` per record, and a window merges them. For vectors
                without any structure, where no cell can be left out

In all, scores are made for so many records at a time that they fit ``cellBytes``. Every record is
a row of its own: ids may repeat or be NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import label_plus_desc, words
from ..settings import measure, row_keyed, salt_values, setting, written
from .cells import Cells, Searched, as_cells, cell_table, nearest_in_cells, with_buckets
from .cells import unit as _matrix

__all__ = ["nearest_labels", "search_cells", "attach_nearest", "ranked_lists", "rerank", "rerank_attached", "token_jaccard"]

DIGITS = 6
COPIES = 4  # of the scores in memory at once: as they are, rounded and in parts


def _top(scores: np.ndarray, k: int) -> list[np.ndarray]:
    """Column numbers of the ``k`` best scores of each row; equal scores in column order."""
    scores = np.round(scores, DIGITS)
    n = scores.shape[1]
    if k >= n:
        return list(np.argsort(-scores, axis=1, kind="stable"))
    floor = np.partition(scores, n - k, axis=1)[:, n - k]
    best = []
    for row, least in zip(scores, floor):
        cols = np.flatnonzero(row >= least)
        best.append(cols[np.argsort(-row[cols], kind="stable")][:k])
    return best


def _slices(vectors: np.ndarray, matrix: np.ndarray, cell: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rounded scores of the vectors against the matrix: first row and scores of each run of rows, a
    run as long as ``cell`` bytes of scores allow, one row at least."""
    step = max(1, cell // (8 * max(1, len(matrix))))
    for at in range(0, len(vectors), step):
        yield at, np.round(vectors[at:at + step] @ matrix.T, DIGITS)


def _fits(labels: DataFrame, vector: str) -> bool:
    """Whether all that the broadcast form ships is within the bound: names, paths, descriptions, vectors."""
    n, size = measure(labels, "label", "path", "description")
    dim = labels.select(F.max(F.size(vector))).first()[0] or 0
    return size + n * dim * 8 <= setting(labels.sparkSession, "broadcastBytes")


def attach_nearest(
    df: DataFrame, labels: DataFrame, k: int, *, key: str = "id", vector: str = "vector",
    label_vector: str = "vector", form: str = "auto", prefix: str = "candidate_", cells: Cells | None = None,
) -> DataFrame:
    """Attach ``<prefix>labels``, ``_scores``, ``_paths`` and ``_descriptions``, best first.

    ``labels`` has ``label`` and a vector, and may have ``path`` and ``description``. With fewer
    than ``k`` labels all are returned. Records without a vector get ``[]``. With ``cells`` the labels are those of
    a stored index and have ``bucket`` (see ``read_index`` and ``read_cells``).
    """
    labels = _label_columns(labels, label_vector, cells is not None)
    if cells is None:
        labels = written(_first_of_vector(labels, k), "near_labels")
    if form == "auto":
        form = "broadcast" if _fits(labels, "_lv") else "cells"
    names = ("labels", "scores", "paths", "descriptions")
    if form in ("grid", "cells"):
        rows = row_keyed(df)
        best = _grid(rows, labels, k, "_row", vector) if form == "grid" else _searched(rows, labels, cells, k, "_row", vector).matches
        lists = ranked_lists(best, "_row", {"labels": "label", "scores": "score", "paths": "path", "descriptions": "description"}, tie="rank")
        merged = rows.join(lists, "_row", "left").drop("_row")
    else:
        merged = df.withColumn("_near", _near_udf(labels, k)(vector)).select("*", "_near.*").drop("_near")
    for name in names:
        kind = "array<double>" if name == "scores" else "array<string>"
        merged = merged.withColumn(name, F.coalesce(F.col(name), F.array().cast(kind)))
    return merged.withColumnsRenamed({n: f"{prefix}{n}" for n in names})


def _label_columns(labels: DataFrame, vector: str, placed: bool) -> DataFrame:
    for c in ("path", "description"):
        if c not in labels.columns:
            labels = labels.withColumn(c, F.lit(None).cast("string"))
    own = ["bucket"] if placed else []
    return labels.select(F.col("label").cast("string"), "path", "description", F.col(vector).alias("_lv"), *own)


def _first_of_vector(labels: DataFrame, k: int) -> DataFrame:
    """Labels without those that can't be among the ``k`` nearest: they have the vector, and so the score, of
    ``k`` labels that come before them by name."""
    rank = F.row_number().over(Window.partitionBy("_lv").orderBy("label", "path"))
    return labels.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def _searched(rows: DataFrame, labels: DataFrame, cells: Cells | None, k: int, key: str, vector: str) -> Searched:
    if cells is None:
        placed, centres = with_buckets(labels, "label", "_lv")
        labels = written(placed, "cells")
        cells = as_cells(cell_table(labels, centres))
    return nearest_in_cells(rows, labels, cells, k, key, vector)


def search_cells(df: DataFrame, labels: DataFrame, k: int, *, vector: str = "vector", label_vector: str = "vector", cells: Cells | None = None) -> Searched:
    """The ``cells`` form on rows numbered in ``_row``, with the number of pairs that were scored and of all pairs."""
    return _searched(df, _label_columns(labels, label_vector, cells is not None), cells, k, "_row", vector)


def _near_udf(labels: DataFrame, k: int):
    table = labels.orderBy("label", "path").toPandas()  # size checked by the caller
    cell = setting(labels.sparkSession, "cellBytes")
    shared = labels.sparkSession.sparkContext.broadcast(
        (table["label"].to_numpy(object), table["path"].to_numpy(object), table["description"].to_numpy(object),
         _matrix(table["_lv"]) if len(table) else None)
    )

    def near(vectors: pd.Series) -> pd.DataFrame:
        names, paths, descriptions, matrix = shared.value
        rows: list[tuple] = [(None, None, None, None)] * len(vectors)
        known = np.flatnonzero(vectors.notna().to_numpy())
        if len(known) and matrix is not None:
            for first, scores in _slices(_matrix(vectors.iloc[known]), matrix, cell // COPIES):
                for at, row, cols in zip(known[first:], scores, _top(scores, k)):
                    rows[at] = (names[cols], row[cols] + 0.0, paths[cols], descriptions[cols])
        return pd.DataFrame(rows, columns=["labels", "scores", "paths", "descriptions"])

    return F.pandas_udf(
        near, _struct("labels array<string>, scores array<double>, paths array<string>, descriptions array<string>")
    )


def _struct(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def nearest_labels(
    df: DataFrame, labels: DataFrame, k: int, *, key: str = "id", vector: str = "vector",
    label_vector: str = "vector", form: str = "auto",
) -> DataFrame:
    """Long form of the join: ``(key, label, path, description, score, rank)``."""
    near = attach_nearest(
        df.select(key, vector), labels, k, key=key, vector=vector, label_vector=label_vector, form=form, prefix="_"
    )
    zipped = F.arrays_zip(
        F.col("_labels").alias("label"), F.col("_paths").alias("path"),
        F.col("_descriptions").alias("description"), F.col("_scores").alias("score"),
    )
    return near.select(key, F.posexplode(zipped).alias("_p", "m")).select(
        key, "m.label", "m.path", "m.description", "m.score", (F.col("_p") + 1).alias("rank")
    )


def _grid(df: DataFrame, labels: DataFrame, k: int, key: str, vector: str) -> DataFrame:
    spark = df.sparkSession
    cell = setting(spark, "cellBytes")
    left = df.select(F.col(key).alias("_key"), F.col(vector).alias("_v")).filter(F.col("_v").isNotNull())
    sizes = left.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_v")).alias("d")).first()
    width = 8 * (sizes["d"] or 1) + 64
    per_block = max(1, cell // width)
    shards = max(1, -(-sizes["n"] // per_block))
    blocks = max(1, -(-labels.count() // per_block))

    a = left.withColumn("_r", F.pmod(F.xxhash64("_key"), F.lit(shards))).withColumn(
        "_b", F.explode(salt_values(blocks))
    )
    b = labels.withColumn("_b", F.pmod(F.xxhash64("label", "path"), F.lit(blocks))).withColumn(
        "_r", F.explode(salt_values(shards))
    )
    partial = _scored(a.withColumn("_least", F.lit(-2.0)), b, ["_r", "_b"], k, cell)
    rank = F.row_number().over(
        Window.partitionBy("_key").orderBy(F.col("score").desc(), F.col("label"), F.col("path"))
    )
    return partial.withColumn("rank", rank).filter(F.col("rank") <= k).withColumnRenamed("_key", key)


def _scored(records: DataFrame, labels: DataFrame, on: list[str], k: int, cell: int) -> DataFrame:
    """The ``k`` best labels of each record (``_key, _v``) among those that share the columns ``on``, of
    scores from ``_least`` up. A group is one task."""
    key_type = records.schema["_key"].dataType.simpleString()

    def block(records: pd.DataFrame, block_labels: pd.DataFrame) -> pd.DataFrame:
        columns = ["_key", "label", "path", "description", "score"]
        if not len(records) or not len(block_labels):
            return pd.DataFrame(columns=columns)
        own = block_labels.sort_values(["label", "path"], kind="stable").reset_index(drop=True)
        parts = []
        for first, scores in _slices(_matrix(records["_v"]), _matrix(own["_lv"]), cell // COPIES):
            picks = _top(scores, k)
            cols = np.concatenate(picks)
            rows = np.repeat(np.arange(len(scores)), [len(p) for p in picks])
            part = own.loc[cols, ["label", "path", "description"]].reset_index(drop=True)
            part.insert(0, "_key", records["_key"].to_numpy()[first + rows])
            part["score"] = scores[rows, cols] + 0.0
            parts.append(part[part["score"].to_numpy() >= records["_least"].to_numpy()[first + rows]])
        return pd.concat(parts, ignore_index=True)

    schema = f"_key {key_type}, label string, path string, description string, score double"
    return records.groupBy(*on).cogroup(labels.groupBy(*on)).applyInPandas(block, schema)


def ranked_lists(
    matches: DataFrame, key: str, columns: dict[str, str], score: str = "score", tie: str = "label"
) -> DataFrame:
    """Matches of each record as aligned lists, highest score first. One row per record."""
    tie_value = F.col(tie) if tie == "rank" else F.col(tie).cast("string")
    entry = F.struct(
        (-F.col(score)).alias("order_score"), tie_value.alias("order_tie"),
        *[F.col(c).alias(f"value_{alias}") for alias, c in columns.items()],
    )
    grouped = matches.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("_m"))
    return grouped.select(key, *[F.transform("_m", _getter(f"value_{alias}")).alias(alias) for alias in columns])


def _getter(name: str):
    return lambda entry: entry[name]


def token_jaccard(a: str | Column, b: str | Column) -> Column:
    """Share of common words among all words of both texts."""
    x, y = F.array_distinct(words(a)), F.array_distinct(words(b))
    union = F.size(F.array_union(x, y))
    return F.when(union > 0, F.size(F.array_intersect(x, y)) / union).otherwise(F.lit(0.0))


def rerank(matches: DataFrame, key: str, second: Column, k: int, tie: str = "label") -> DataFrame:
    """Order first-stage candidates by a second score and keep the best ``k`` per record.

    ``second`` is computed before the shuffle, so texts it reads do not travel.
    """
    keep = [c for c in ("label", "path", "description", "score") if c in matches.columns]
    scored = matches.select(key, *keep, F.round(second, DIGITS).alias("second_score"))
    order = [F.col("second_score").desc(), F.col("score").desc(), F.col(tie)]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= k)


def rerank_attached(df: DataFrame, text: str, k: int, prefix: str = "candidate_") -> DataFrame:
    """Second stage for :func:`attach_nearest`, in the row: candidates are ordered by the share of
    words that the text and the label with its description have in common, then by their first score
    and name, and the best ``k`` stay. All four lists follow."""
    names = ("labels", "scores", "paths", "descriptions")
    zipped = F.arrays_zip(*[F.col(f"{prefix}{n}").alias(n) for n in names])
    with_words = F.transform(zipped, lambda e: F.struct(F.array_distinct(words(label_plus_desc(e["labels"], e["descriptions"]))).alias("theirs"), e.alias("e")))
    own = F.array_distinct(words(text))

    def order(row: Column) -> Column:
        def entry(c: Column) -> Column:
            common = F.size(F.array_intersect(c["theirs"], row["met"]))
            union = row["n"] + F.size(c["theirs"]) - common
            share = F.when(union > 0, common / union).otherwise(F.lit(0.0))
            return F.struct((-F.round(share, DIGITS)).alias("second"), (-c["e"]["scores"]).alias("first"), *[c["e"][n].alias(n) for n in names])

        return F.slice(F.array_sort(F.transform(row["all"], entry)), 1, k)

    def met(row: Column) -> Column:
        # the words of the text that any candidate has: few, so the long list is gone through once
        return F.struct(row["all"].alias("all"), F.size(row["own"]).alias("n"),
                        F.array_intersect(row["own"], F.flatten(F.transform(row["all"], lambda c: c["theirs"]))).alias("met"))

    # one-element arrays hold what is made once per record
    bound = F.array(F.struct(with_words.alias("all"), own.alias("own")))
    best = F.transform(F.transform(bound, met), order)[0]
    out = df.withColumn("_best", best)
    for n in names:
        out = out.withColumn(f"{prefix}{n}", F.coalesce(F.transform("_best", _getter(n)), F.col(f"{prefix}{n}")))
    return out.drop("_best")
