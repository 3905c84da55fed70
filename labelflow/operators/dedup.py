"""Duplicate removal and row accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import written

__all__ = ["count_duplicates", "keep_newest", "keep_first", "stage_counts", "write_counted", "observed_counts"]


def count_duplicates(df: DataFrame, key: str | Column) -> DataFrame:
    """Rows after the first of each key; NULL keys form one group. Counts combine map-side."""
    k = F.col(key) if isinstance(key, str) else key
    sizes = df.groupBy(k.alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def keep_newest(df: DataFrame, key: str, when: str, tie: str = "id") -> DataFrame:
    """Newest row of each key, undated rows last, smallest ``tie`` on equal dates.

    Spark turns the rank filter into a group limit below the shuffle: every map task passes on
    at most one row per key, so a key that holds a third of all rows does not gather anywhere.
    """
    return _first(df, key, [F.col(when).desc_nulls_last(), F.col(tie).asc_nulls_last()])


def keep_first(df: DataFrame, key: str, order: str = "id") -> DataFrame:
    """First row of each key by ``order``."""
    return _first(df, key, [F.col(order).asc_nulls_last()])


def _first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def stage_counts(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows that pass each stage (a boolean column), and rows dropped, in one pass over ``df``."""
    total = F.count(F.lit(1))
    rows = [
        F.struct(F.lit(name).alias("stage"), F.count_if(ok).alias("kept"), (total - F.count_if(ok)).alias("dropped"))
        for name, ok in stages.items()
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def observed_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """``(stage, n)`` of counts that were observed."""
    return spark.createDataFrame(list(counts.items()), "stage string, n bigint")


def write_counted(df: DataFrame, name: str, stages: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` and count while it is written: the written table, and the rows of :func:`stage_counts`.

    The metrics are taken in the stage that writes, whose tasks are counted once however often they are run.
    """
    told = Observation()
    counts = {f"kept_{i}": F.count_if(ok).alias(f"kept_{i}") for i, ok in enumerate(stages.values())}
    out = written(df.observe(told, F.count(F.lit(1)).alias("total"), *counts.values()), name)
    total, got = told.get["total"], told.get
    rows = [(stage, got[f"kept_{i}"], total - got[f"kept_{i}"]) for i, stage in enumerate(stages)]
    return out, df.sparkSession.createDataFrame(rows, "stage string, kept bigint, dropped bigint")
