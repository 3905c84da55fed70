"""Counts, profiles and samples. Every aggregate combines map-side; none gathers a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import or_empty, percentage, sample_order
from ..settings import written
from .numbering import exact_quantiles, numbered

__all__ = [
    "label_frequency", "label_statistics", "labelled_share", "value_counts", "top_values", "null_counts",
    "column_info", "numeric_summary", "list_totals", "invalid_dates", "cluster_sizes", "cluster_labels",
    "top_items", "labels_in_use", "cluster_count", "joined_samples", "run_statistics", "write_with_statistics", "sort_rows", "first_rows",
    "sample_rows", "sample_fraction", "sample_per_group", "with_batches", "new_label_candidates",
]


def _items(df: DataFrame, column: str, alias: str = "label") -> DataFrame:
    return df.select(F.explode(column).alias(alias))


def label_frequency(df: DataFrame, column: str) -> DataFrame:
    """``(label, count)``, most frequent first."""
    counts = _items(df, column).groupBy("label").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), "label")


def label_statistics(df: DataFrame, column: str) -> DataFrame:
    """``(label, count, percentage)`` of all records, labelled or not. One pass: a mark per record is counted with the labels."""
    mark = F.array(F.struct(F.lit(True).alias("record"), F.lit(None).cast(df.schema[column].dataType.elementType).alias("label")))
    said = F.transform(column, lambda x: F.struct(F.lit(False).alias("record"), x.alias("label")))
    items = df.select(F.inline(F.concat(mark, F.coalesce(said, F.slice(mark, 1, 0)))))
    counted = written(items.groupBy("record", "label").agg(F.count(F.lit(1)).alias("count")), "label_counts")
    total = counted.agg(F.coalesce(F.sum(F.when(F.col("record"), F.col("count"))), F.lit(0))).scalar()
    counts = counted.filter("NOT record").select("label", "count")
    return counts.withColumn("percentage", percentage("count", total)).orderBy(F.col("count").desc(), "label")


def labelled_share(df: DataFrame, column: str) -> DataFrame:
    has = F.count_if(F.size(or_empty(column)) > 0)
    total = F.count(F.lit(1))
    return df.agg(total.alias("records"), has.alias("labelled"), percentage(has, total).alias("percentage"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, count)`` without NULL, most frequent first."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), "value")


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).limit(n)


def _per_column(df: DataFrame, measures: dict[str, Column], name: str) -> DataFrame:
    rows = [F.struct(F.lit(c).alias("column"), m.alias(name)) for c, m in measures.items()]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls)`` of all columns in one pass."""
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "nulls")


def column_info(df: DataFrame) -> DataFrame:
    """``(column, non_null, type)`` of all columns in one pass."""
    rows = [
        F.struct(F.lit(f.name).alias("column"), F.count(f.name).alias("non_null"), F.lit(f.dataType.simpleString()).alias("type"))
        for f in df.schema.fields
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def numeric_summary(df: DataFrame, columns: list[str] | None = None, max_distinct: int = 1_000_000) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of the numeric columns, one row each.

    Quartiles are exact and interpolate linearly. ``percentile`` keeps one counter per distinct
    value, so columns with more than ``max_distinct`` values are sorted instead and read by
    position; one pass decides.
    """
    numeric = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    spread = df.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first()
    quartiles = {}
    for c in numeric:
        if spread[c] <= max_distinct:
            quartiles[c] = [F.percentile(c, q) for q in (0.25, 0.5, 0.75)]
        else:
            quartiles[c] = [F.lit(v).cast("double") for v in exact_quantiles(df, c, [0.25, 0.5, 0.75])]
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
            F.min(c).cast("double").alias("min"), quartiles[c][0].alias("q25"), quartiles[c][1].alias("q50"),
            quartiles[c][2].alias("q75"), F.max(c).cast("double").alias("max"),
        )
        for c in numeric
    ]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def list_totals(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per list column: items, records with an item, their share, mean length."""
    total = F.count(F.lit(1))
    rows = []
    for c in columns:
        n = F.size(or_empty(c))
        has = F.count_if(n > 0)
        rows.append(F.struct(
            F.lit(c).alias("column"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("items"),
            has.alias("records_with_items"), percentage(has, total).alias("percentage"), F.round(F.avg(n), 2).alias("mean_length"),
        ))
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def invalid_dates(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNull()).alias("invalid_dates"))


def cluster_sizes(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count")).orderBy(cluster)


def cluster_labels(df: DataFrame, column: str, cluster: str = "cluster_id") -> DataFrame:
    """Distinct labels used inside each cluster, sorted, and as text (``None`` when empty).

    Pairs are made distinct before they are gathered, so a list holds each label once.
    """
    pairs = df.select(cluster, F.explode_outer(column).alias("label")).distinct()
    lists = pairs.groupBy(cluster).agg(F.array_sort(F.collect_list("label")).alias("labels"))
    text = F.when(F.size("labels") == 0, "None").otherwise(F.array_join("labels", ", "))
    return lists.withColumn("labels_text", text)


def top_items(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Most frequent items of a list column."""
    counts = _items(df, column, "item").groupBy("item").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), "item").limit(n)


def labels_in_use(df: DataFrame, column: str) -> DataFrame:
    return _items(df, column).distinct()


def cluster_count(df: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Number of clusters; -1 stands for unclustered and is not counted."""
    c = F.col(cluster)
    return df.agg(F.count_distinct(F.when(c != -1, c)).alias("clusters"))


def joined_samples(samples: DataFrame, group: str, text: str, rank: str = "rank", separator: str = ". ") -> DataFrame:
    """Texts of each group joined in rank order. For samples only: the list is gathered per group."""
    entry = F.struct(F.col(rank).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    lists = samples.groupBy(group).agg(F.array_sort(F.collect_list(entry)).alias("_l"))
    return lists.select(group, F.array_join(F.transform("_l", lambda e: e["t"]), separator).alias("sample_text"))


def run_statistics(df: DataFrame, labels: DataFrame, column: str, run_id: str) -> DataFrame:
    """One row: records, labels available, labels assigned, mean per record, run id."""
    n = F.size(or_empty(column))
    out = df.agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("labels_assigned"),
        F.round(F.avg(n), 2).alias("mean_labels"),
    )
    available = labels.select("label").distinct().agg(F.count(F.lit(1))).scalar()
    return out.select("records", available.alias("labels_available"), "labels_assigned", "mean_labels", F.lit(run_id).alias("run_id"))


def write_with_statistics(df: DataFrame, labels: DataFrame, column: str, run_id: str, name: str = "run") -> tuple[DataFrame, DataFrame]:
    """Write ``df`` and give the row of :func:`run_statistics`, gathered by the tasks that write."""
    told, n = Observation(), F.size(or_empty(column))
    out = written(df.observe(told, F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("labels_assigned")), name)
    available = labels.select("label").distinct().agg(F.count(F.lit(1)).alias("labels_available"))
    records, assigned = told.get["records"], told.get["labels_assigned"]
    mean = F.round(F.try_divide(F.lit(assigned), F.lit(records)), 2).cast("double")
    return out, available.select(
        F.lit(records).cast("bigint").alias("records"), "labels_available", F.lit(assigned).cast("bigint").alias("labels_assigned"),
        mean.alias("mean_labels"), F.lit(run_id).alias("run_id"))


# -- order, limit, sample ---------------------------------------------------------------------

def _order(spec: dict[str, bool]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in spec.items()]


def sort_rows(df: DataFrame, spec: dict[str, bool]) -> DataFrame:
    """Sort by several columns; ``True`` is ascending. NULL is last either way."""
    return df.orderBy(*_order(spec))


def first_rows(df: DataFrame, n: int, spec: dict[str, bool]) -> DataFrame:
    return df.orderBy(*_order(spec)).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` pseudo-random rows (all rows if fewer), the same for any partitioning."""
    return df.withColumn("_o", sample_order(key, seed)).orderBy("_o", key).limit(n).drop("_o")


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, chosen by hash: one narrow pass, repeatable."""
    point = F.conv(F.substring(sample_order(key, seed), 1, 8), 16, 10).cast("double") / float(2**32)
    return df.filter(point < fraction)


def sample_per_group(df: DataFrame, group: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` pseudo-random rows of each group, with ``rank``, in one pass.

    The group limit also applies before the shuffle, so a large group sends ``n`` rows per task.
    """
    ordered = df.withColumn("_o", sample_order(key, seed))
    rank = F.row_number().over(Window.partitionBy(group).orderBy("_o", key))
    return ordered.withColumn("rank", rank).filter(F.col("rank") <= n).drop("_o")


def with_batches(df: DataFrame, key: str, size: int) -> DataFrame:
    """Add ``batch_id``: batches of at most ``size`` rows in key order."""
    rows = numbered(df, [F.col(key).asc_nulls_last()], "_index")
    return rows.withColumn("batch_id", F.floor(F.col("_index") / size).cast("bigint")).drop("_index")


def new_label_candidates(themes: DataFrame, in_use: DataFrame, *, ignore_case: bool = False) -> DataFrame:
    """Themes and subtopics that are no label in use. ``themes``: ``cluster_theme, subtopics``."""
    potential = themes.select(
        F.explode(F.concat(F.array("cluster_theme"), or_empty("subtopics"))).alias("label")
    ).filter(F.col("label").isNotNull()).distinct()
    known = in_use.select(F.col("label").alias("_known")).distinct()
    same = (
        F.lower(F.col("label")) == F.lower(F.col("_known")) if ignore_case else F.col("label") == F.col("_known")
    )
    return potential.join(known, same, "left_anti")
