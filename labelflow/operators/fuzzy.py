"""Names that differ by a few letters: segments as join keys, edit distance on the candidates.

A name cut into ``distance + 1`` segments keeps one of them whole under ``distance`` edits, moved by at most that
many places. So names meet under the length of the one, the number of a segment and its letters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import row_keyed
from .skew import join_unique, salted_join

__all__ = ["fuzzy_pairs", "match_entities_fuzzy"]


def _segments(length: Column, parts: int) -> Column:
    """``i, at, size`` of the segments of a name of that many letters."""
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(
        i.alias("i"), F.floor(i * length / parts).cast("int").alias("at"),
        (F.floor((i + 1) * length / parts) - F.floor(i * length / parts)).cast("int").alias("size")))


def fuzzy_pairs(names: DataFrame, targets: DataFrame, distance: int) -> DataFrame:
    """``name, target, distance`` of all pairs of distinct ``name`` and ``target`` that are at most ``distance``
    inserted, deleted or replaced letters apart. NULL matches nothing."""
    parts = distance + 1
    left = names.select("name").filter(F.col("name").isNotNull()).distinct()
    right = targets.select("target").filter(F.col("target").isNotNull()).distinct()
    size = F.char_length("target")
    cut = right.select("target", size.alias("n"), F.inline(_segments(size, parts)))
    keys = cut.select("target", "n", "i", F.substring("target", F.col("at") + 1, F.col("size")).alias("segment"))

    own = F.char_length("name")
    lengths = F.sequence(F.greatest(F.lit(0), own - distance), own + distance)
    asked = left.withColumn("n", F.explode(lengths)).select("name", "n", F.inline(_segments(F.col("n"), parts)))
    moved = asked.withColumn("start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - distance), F.col("at") + distance)))
    inside = moved.filter(F.col("start") + F.col("size") <= F.char_length("name"))
    probes = inside.select("name", "n", "i", F.substring("name", F.col("start") + 1, F.col("size")).alias("segment")).distinct()

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn("key", F.struct("n", "i", "segment"))

    met = salted_join(keyed(probes).select("key", "name"), keyed(keys).select("key", "target"), "key", "name").select("name", "target").distinct()
    far = met.withColumn("distance", F.levenshtein("name", "target", distance))
    return far.filter(F.col("distance") >= 0)


def match_entities_fuzzy(df: DataFrame, column: str, labels: DataFrame, out: str, distance: int = 1) -> DataFrame:
    """Attach to each row the labels nearest to its entities, as a sorted list: for each entity those of the least
    edit distance, at most ``distance``, upper and lower case being the same. Every row is one of its own."""
    rows = row_keyed(df)
    said = rows.select("_row", F.explode(column).alias("entity")).select("_row", F.lower("entity").alias("name")).filter(F.col("name").isNotNull()).distinct()
    known = labels.select("label", F.lower("label").alias("target")).distinct()
    pairs = fuzzy_pairs(said, known, distance)
    named = pairs.join(known, "target")
    best = named.groupBy("name").agg(F.min("distance").alias("least"))
    lists = named.join(best, "name").filter(F.col("distance") == F.col("least")).groupBy("name").agg(F.collect_set("label").alias("near"))
    sizes = said.groupBy("name").agg(F.count(F.lit(1)).alias("times"))
    found = join_unique(said, lists.join(sizes, "name"), "name", "times", said.count())
    per_row = found.groupBy("_row").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias(out))
    matched = rows.drop(out).join(per_row, "_row", "left").drop("_row")
    return matched.withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
