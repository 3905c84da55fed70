"""Which labels occur together: pair support and lift from label lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..settings import written
from .skew import join_unique

__all__ = ["label_pairs"]

CHUNK = 64  # labels of a list that are paired in one row


def _pairs(a: Column, b: Column) -> Column:
    """All pairs of an item of ``a`` and a larger one of ``b``."""
    return F.flatten(F.transform(a, lambda x: F.transform(F.filter(b, lambda y: y > x), lambda y: F.struct(x.alias("label_a"), y.alias("label_b")))))


def label_pairs(df: DataFrame, column: str, min_support: int = 1, chunk: int = CHUNK) -> DataFrame:
    """``label_a, label_b, together, count_a, count_b, lift`` of the labels that ``min_support`` or more rows have both.

    ``lift`` is how much more often than by chance: ``together * rows / (count_a * count_b)``, all rows counted. A label
    counts once a row. Labels below ``min_support`` can't be in such a pair and are taken out first. A list is cut into
    chunks, and every two chunks are a row of their own, so a very long list is many tasks; pairs are
    counted where they are made. The lists are made once and written, as they are read several times.
    """
    rows = written(df.select(F.array_sort(F.array_distinct(F.filter(column, lambda x: x.isNotNull()))).alias("l")), "label_lists")
    total = F.lit(rows.count())
    counts = rows.select(F.explode("l").alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.filter(F.col("n") >= min_support), "label_counts")
    if min_support > 1:
        items = rows.withColumn("_row", F.monotonically_increasing_id())
        said = written(items.select("_row", F.explode("l").alias("label")), "said")
        kept = join_unique(said, counts.select("label", "n"), "label", "n", said.count())
        rows = kept.groupBy("_row").agg(F.array_sort(F.collect_list("label")).alias("l")).select("l")
    long = rows.filter(F.size("l") > 1)
    parts = F.transform(F.sequence(F.lit(0), ((F.size("l") - 1) / chunk).cast("int")), lambda i: F.slice("l", i * chunk + 1, chunk))
    cut = long.select(parts.alias("p"))
    two = cut.select("p", F.posexplode("p").alias("at", "a")).select("a", F.explode(F.slice("p", F.col("at") + 1, F.size("p"))).alias("b"))
    counted = two.select(F.inline(_pairs(F.col("a"), F.col("b")))).groupBy("label_a", "label_b").agg(F.count(F.lit(1)).alias("together"))
    pairs = written(counted.filter(F.col("together") >= min_support), "label_pairs")
    n = pairs.count()
    for side in ("a", "b"):
        uses = pairs.groupBy(f"label_{side}").agg(F.count(F.lit(1)).alias("_uses"))
        named = counts.select(F.col("label").alias(f"label_{side}"), F.col("n").alias(f"count_{side}")).join(uses, f"label_{side}")
        pairs = join_unique(pairs, named, f"label_{side}", "_uses", n)
    lift = F.round(F.col("together") * total / (F.col("count_a") * F.col("count_b").cast("double")), 6)
    return pairs.select("label_a", "label_b", "together", "count_a", "count_b", lift.alias("lift"))
