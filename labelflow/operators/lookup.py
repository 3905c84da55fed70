"""Look up every item of a list column in a label table.

One operator, ``map_list``, carries entity matching, label validation and hierarchy closure. Forms,
chosen by the measured size of the mapping:

* ``inline``    a few entries: a value of the plan itself, looked up in the JVM, no shuffle. Spark looks through
                a map entry by entry, so there are as many small maps as entries, and an item is looked for
                in the one at the place of its hash
* ``broadcast`` entries within the bound: a hash table per worker, Arrow batches, no shuffle
* ``join``      any size: equi join, salted by record so that an item that stands in a third of all
                lists is spread over many tasks

A form that is asked for gives way to the next one where the mapping is beyond its bound. All forms treat every row by itself. ``key`` names the record id, which may repeat or be NULL: rows are
told apart by a number of their own.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import empty_strings, or_empty
from ..settings import measure, row_keyed, setting, written
from .skew import salted_join
from .taxonomy import closure_table

__all__ = [
    "map_list", "match_entities", "validate_labels", "unknown_labels", "close_hierarchy", "merge_on_id",
    "update_by_key", "combine_lists", "label_paths", "valid_items", "invalid_items",
]


def map_list(
    df: DataFrame, key: str, column: str, mapping: DataFrame, out: str, *,
    keep_unmatched: bool, as_set: bool, lower: bool = False, form: str = "auto",
) -> DataFrame:
    """Replace each item of ``column`` by ``mapping(item, values)`` and flatten.

    Items without an entry are kept or dropped. ``as_set`` gives distinct sorted items, else the
    order and the repeats stay.
    """
    if form in ("auto", "inline"):
        mapping = written(mapping, "mapping")  # made once, then measured and shipped
        n, size = measure(mapping, "item", "values")
        spark = df.sparkSession
        if size > setting(spark, "inlineBytes") or (form == "auto" and n > setting(spark, "inlineRows")):
            form = "broadcast" if size <= setting(spark, "broadcastBytes") else "join"
        else:
            form = "inline"
    as_key = F.lower if lower else (lambda c: c)
    missing = (lambda x: F.array(x)) if keep_unmatched else (lambda x: empty_strings())
    finish = (lambda c: F.array_sort(F.array_distinct(c))) if as_set else (lambda c: c)
    items = F.filter(or_empty(column), lambda x: x.isNotNull())

    if form == "inline":
        maps, n = _hashed_maps(mapping)
        own = lambda x: F.try_element_at(F.get(maps, _place(as_key(x), n)), as_key(x))
        return df.withColumn(out, finish(F.flatten(F.transform(items, lambda x: F.coalesce(own(x), missing(x))))))

    if form == "broadcast":
        return df.withColumn(out, _hash_lookup(mapping, keep_unmatched, as_set)(items, F.transform(items, as_key)))

    rows = row_keyed(df.withColumn("_items", items))
    left = rows.select("_row", F.posexplode("_items").alias("_pos", "_raw")).withColumn("_item", as_key(F.col("_raw")))
    right = mapping.select(F.col("item").alias("_item"), F.col("values").alias("_values"))
    joined = salted_join(left, right, "_item", "_row", "left" if keep_unmatched else "inner")
    values = F.coalesce(F.col("_values"), F.array("_raw"))
    lists = joined.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("_pos", values.alias("v")))).alias("_l"))
    flat = lists.select("_row", finish(F.flatten(F.transform("_l", lambda s: s["v"]))).alias("_flat"))
    return rows.drop("_items").join(flat, "_row", "left").withColumn(out, or_empty("_flat")).drop("_row", "_flat")


def _place(item: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(n)).cast("int")


def _hashed_maps(mapping: DataFrame) -> tuple[Column, int]:
    """A constant, the mapping as a list of maps with an entry at the place of its item's hash, and their number.

    A column of the rows with the same value would be copied into every row wherever Spark puts a step between.
    """
    known = mapping.filter(F.col("item").isNotNull())
    n = max(1, known.count())
    maps: list[dict] = [{} for _ in range(n)]
    for r in known.select(_place(F.col("item"), n).alias("at"), "item", "values").collect():  # size checked by the caller
        if r["item"] in maps[r["at"]]:
            raise ValueError(f"{r['item']!r} is mapped twice")
        maps[r["at"]][r["item"]] = r["values"]
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,array<string>>>"), n


def _hash_lookup(mapping: DataFrame, keep_unmatched: bool, as_set: bool):
    rows = mapping.select("item", "values").toPandas()  # size checked by the caller
    table = {item: list(values) for item, values in zip(rows["item"], rows["values"])}
    shared = mapping.sparkSession.sparkContext.broadcast(table)

    def lookup(lists: pd.Series, keys: pd.Series) -> pd.Series:
        table = shared.value
        out = []
        for raw, items in zip(lists, keys):
            found = [v for x, item in zip(raw, items) for v in table.get(item, (x,) if keep_unmatched else ())]
            out.append(sorted(set(found)) if as_set else found)
        return pd.Series(out)

    return F.pandas_udf(lookup, T.ArrayType(T.StringType()))


def match_entities(df: DataFrame, key: str, column: str, labels: DataFrame, out: str, form: str = "auto") -> DataFrame:
    """Labels equal to an entity but for case, in the label's own case, distinct and sorted."""
    mapping = labels.groupBy(F.lower("label").alias("item")).agg(F.array(F.max("label")).alias("values"))
    return map_list(df, key, column, mapping, out, keep_unmatched=False, as_set=True, lower=True, form=form)


def validate_labels(df: DataFrame, key: str, column: str, labels: DataFrame, out: str, form: str = "auto") -> DataFrame:
    """Predicted labels that are in the label table; order and repeats stay, case matters."""
    mapping = labels.select(F.col("label").alias("item")).distinct().select("item", F.array("item").alias("values"))
    return map_list(df, key, column, mapping, out, keep_unmatched=False, as_set=False, form=form)


def unknown_labels(df: DataFrame, key: str, column: str, labels: DataFrame, out: str, form: str = "auto") -> DataFrame:
    """Predicted labels that are not in the label table, distinct and sorted."""
    mapping = labels.select(F.col("label").alias("item")).distinct().select("item", empty_strings().alias("values"))
    return map_list(df, key, column, mapping, out, keep_unmatched=True, as_set=True, form=form)


def valid_items(predicted: str | Column, allowed: str | Column) -> Column:
    """In-row form for lists that carry their own allowed labels."""
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    a = F.col(allowed) if isinstance(allowed, str) else allowed
    return F.filter(or_empty(p), lambda x: F.array_contains(or_empty(a), x))


def invalid_items(predicted: str | Column, allowed: str | Column) -> Column:
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    a = F.col(allowed) if isinstance(allowed, str) else allowed
    return F.array_sort(F.array_except(or_empty(p), or_empty(a)))


def close_hierarchy(
    df: DataFrame, key: str, column: str, labels: DataFrame, out: str, enabled: bool = True, form: str = "auto"
) -> DataFrame:
    """Add every ancestor label of each chosen label; distinct and sorted.

    Disabled, the list is passed on as it is.
    """
    if not enabled:
        return df.withColumn(out, or_empty(column))
    closed = closure_table(labels).select(
        F.col("label").alias("item"), F.concat(F.array("label"), F.col("parents")).alias("values")
    )
    return map_list(df, key, column, closed, out, keep_unmatched=True, as_set=True, form=form)


def label_paths(df: DataFrame, labels: DataFrame, column: str = "label", key: str = "id") -> DataFrame:
    """Add the path of a label name; of repeated names the last in taxonomy order counts."""
    paths = labels.groupBy(F.col("label").alias(column)).agg(F.max_by("path", "pos").alias("path"))
    return salted_join(df, paths, column, key, "left")


def merge_on_id(df: DataFrame, lists: DataFrame, key: str = "id") -> DataFrame:
    """Keep every record and attach list columns; records without a match get ``[]``."""
    merged = df.join(lists, key, "left")
    for field in lists.schema.fields:
        if field.name != key and field.dataType.typeName() == "array":
            merged = merged.withColumn(field.name, F.coalesce(F.col(field.name), F.array().cast(field.dataType)))
    return merged


def update_by_key(df: DataFrame, other: DataFrame, key: str, column: str, default: object = None) -> DataFrame:
    """Overwrite ``column`` where ``other`` has a value for the key, else keep it (or the default)."""
    new = other.select(key, F.col(column).alias("_new"))
    value = F.coalesce(F.col("_new"), F.col(column)) if column in df.columns else F.col("_new")
    if default is not None:
        value = F.coalesce(value, F.lit(default))
    return df.join(new, key, "left").withColumn(column, value).drop("_new")


def combine_lists(a: str | Column, b: str | Column) -> Column:
    """Distinct sorted union of two list columns; NULL counts as ``[]``."""
    return F.array_sort(F.array_union(or_empty(a), or_empty(b)))
