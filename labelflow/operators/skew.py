"""Equi joins for keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

__all__ = ["salted_join", "join_unique", "join_unique_parts"]

SHARE = 1000  # a key with more than one thousandth of the rows is hot; fewer than a thousand keys can be


def _hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and ``_salts`` of the hot keys: one salt for each thousandth of all rows that it has."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.agg(F.count(F.lit(1))).scalar()
    salts = F.ceil(F.col("_n") * SHARE / F.greatest(total, F.lit(1)))
    return counts.withColumn("_salts", salts).filter("_salts > 1").select(key, "_salts")


def salted_join(left: DataFrame, right: DataFrame, on: str, spread_by: str, how: str = "inner") -> DataFrame:
    """Join a long ``left`` with a short ``right`` on ``on``.

    The rows of a hot key are spread by a hash of ``spread_by`` over as many tasks as they fill
    thousandths of the table, and the short side's rows of that key are copied as often. Other keys
    are joined as they are. The hot keys are counted first (with a map-side combine) and broadcast:
    there are fewer than a thousand by their definition.
    """
    hot = F.broadcast(_hot_keys(left, on))
    salts = F.when(F.col(on).isNull(), SHARE).otherwise(F.coalesce("_salts", F.lit(1)))
    a = left.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts)).drop("_salts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
    b = right.join(hot, on, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return a.join(b, [on, "_salt"], how).drop("_salt")


def join_unique_parts(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> tuple[DataFrame, DataFrame]:
    """The two parts of :func:`join_unique`: the rows of hot keys, and the others, which are
    partitioned by the key. No key is in both."""
    table = table.withColumn("_hot", F.col(count) * SHARE > F.lit(total))
    hot = F.broadcast(table.filter("_hot").drop("_hot", count))
    cold = table.filter("NOT _hot").drop("_hot", count)
    return rows.join(hot, key), rows.join(hot.select(key), key, "left_anti").join(cold, key)


def join_unique(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per ``key`` and in ``count`` the
    number of ``rows`` with that key; ``total`` is the sum of the counts.

    The part of ``table`` with hot keys is broadcast (fewer than a thousand rows), so their rows are
    not shuffled; no other key brings more than a thousandth of the rows to a task.
    """
    hot, cold = join_unique_parts(rows, table, key, count, total)
    return hot.unionByName(cold)
