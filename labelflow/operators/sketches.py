"""Profiles that can be merged: sketches per part of a table, kept beside it.

A part (a day, a batch) is read once. The profile of all parts, or of any of them, is merged from rows of some
kilobytes: counts and bounds are exact, distinct values (HLL), quantiles (KLL) and frequent values are estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["sketch_columns", "merge_sketches", "sketch_summary", "store_sketches", "read_sketches"]

TRACKED = 4096  # frequent values per sketch: counts are exact up to about three quarters as many distinct ones
LONG = 256  # characters; a longer value is known by its SHA-256 hash, so that a sketch stays small
QUARTERS = (0.25, 0.5, 0.75)


def sketch_columns(df: DataFrame, columns: list[str] | None = None, part: Column | None = None) -> DataFrame:
    """A row per part and column: ``part, column, n, nulls, low, high, values, ranks, common``.

    ``columns`` are all that are no lists, maps, structs or bytes if not named. ``part`` is NULL if not given. ``low``,
    ``high`` and the quantile sketch ``ranks`` are for numbers (NaN left out, as NULL). One pass; tasks send one row
    per part and column. An empty table has no rows.
    """
    plain = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    names = columns if columns is not None else [c for c, kind in kinds.items() if not isinstance(kind, plain)]

    def cell(name: str) -> Column:
        text = F.col(f"`{name}`").cast("string")
        number = F.col(f"`{name}`").cast("double") if isinstance(kinds[name], T.NumericType) else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column"), F.when(F.length(text) > LONG, F.sha2(text, 256)).otherwise(text).alias("value"),
            F.when(~F.isnan(number), number).alias("number"))

    cells = df.select((F.lit(None) if part is None else part).cast("string").alias("part"), F.inline(F.array(*map(cell, names))))
    return cells.groupBy("part", "column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("nulls"), F.min("number").alias("low"), F.max("number").alias("high"),
        F.hll_sketch_agg("value").alias("values"), F.kll_sketch_agg_double("number").alias("ranks"),
        F.expr(f"approx_top_k_accumulate(value, {TRACKED})").alias("common"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column, of the same columns but ``part``: what one pass over all the parts would have given,
    up to the errors of the sketches. Sketches may be merged again."""
    return sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("ranks").alias("ranks"),
        F.expr(f"approx_top_k_combine(common, {TRACKED})").alias("common"))


def sketch_summary(sketches: DataFrame, quantiles: tuple[float, ...] = QUARTERS, top: int = 10) -> DataFrame:
    """``column, n, nulls, low, high, n_distinct, quantiles, top``, read off rows of sketches: estimated distinct values (a
    standard error of 1.6 %), quantiles (rank error about 1.7 %; NULL without numbers), and the most frequent values
    (``item, count``, ties in order of the value)."""
    at = F.array(*(F.lit(float(q)) for q in quantiles))
    ranks = F.when(F.kll_sketch_get_n_double("ranks") > 0, F.kll_sketch_get_quantile_double("ranks", at))
    frequent = F.filter(F.expr(f"approx_top_k_estimate(common, {TRACKED})"), lambda s: s["item"].isNotNull())  # NULL is tracked as well
    ordered = F.transform(F.array_sort(F.transform(frequent, lambda s: F.struct(-s["count"], s["item"]))), lambda s: F.struct(s["item"].alias("item"), (-s["col1"]).alias("count")))
    kept = [c for c in ("part", "column", "n", "nulls", "low", "high") if c in sketches.columns]
    return sketches.select(*kept, F.hll_sketch_estimate("values").alias("n_distinct"), ranks.alias("quantiles"), F.slice(ordered, 1, top).alias("top"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write sketches to ``path``, a folder per part. A part that is there already is replaced, so a batch that is
    taken again counts once; the other parts stay."""
    sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The sketches of all parts under ``path``; filter ``part`` for some of them. Parts are texts, whatever they look like."""
    schema = spark.read.parquet(path).schema
    fields = [T.StructField("part", T.StringType()) if f.name == "part" else f for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)
