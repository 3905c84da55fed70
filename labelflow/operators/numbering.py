"""Global row numbers without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..settings import written

__all__ = ["numbered", "exact_quantiles"]


def numbered(df: DataFrame, order: list[Column] | None = None, column: str = "row_index") -> DataFrame:
    """Add a dense 0-based row number in the given order (or in scan order).

    Rows are range-sorted and written once with their partition and their place in it; the sizes
    of the partitions, one row each, give the offset of every partition. The written table also
    keeps the numbers fixed when an executor is lost. Columns of ``df`` may have any names.
    """
    part, place, before_part = _free(df, "_part"), _free(df, "_place"), _free(df, "_offset")
    sorted_rows = df.orderBy(*order) if order else df
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    table = written(sorted_rows.withColumn(part, F.spark_partition_id()).withColumn(place, number), "numbered")
    sizes = table.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(before_part))
    # one row per partition of the sorted table: the number of tasks bounds it
    joined = table.join(F.broadcast(offsets), part)
    return joined.withColumn(column, F.col(before_part) + F.col(place)).drop(part, place, before_part)


def _free(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def exact_quantiles(df: DataFrame, column: str, points: list[float]) -> list[float | None]:
    """Quantiles with linear interpolation by sorted position; memory does not grow with the data.

    Equal values are counted first, with a map-side combine, and only ``(value, count)`` is sorted,
    so a value that a third of all rows have is one row of the sort.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull())
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v")
    table = written(counts.withColumn("_part", F.spark_partition_id()), "quantiles")
    sizes = table.groupBy("_part").agg(F.sum("n").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    so_far = Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per partition of the sorted table: the number of tasks bounds it
    ranked = table.join(F.broadcast(offsets), "_part").withColumn("_last", F.col("_offset") + F.sum("n").over(so_far))
    n = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if n == 0:
        return [None] * len(points)
    spots = [q * (n - 1) for q in points]
    wanted = sorted({p for s in spots for p in (int(s), min(int(s) + 1, n - 1))})
    place = F.explode(F.filter(F.array(*map(F.lit, wanted)), lambda p: (p < F.col("_last")) & (p >= F.col("_last") - F.col("n"))))
    at = {r["at"]: r["v"] for r in ranked.select(place.alias("at"), "v").collect()}
    out = []
    for s in spots:
        low = at[int(s)]
        high = at[min(int(s) + 1, n - 1)]
        out.append(low + (high - low) * (s - int(s)))
    return out
