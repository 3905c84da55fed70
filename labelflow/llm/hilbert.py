"""Shards along a Hilbert curve, in DataFrame functions only.

Each dimension is cut into ``2 ** bits`` bins at its quantiles, the bins are the coordinates of a
cell, and rows are sorted by the cell's place on the curve. Runs of equal length are cut from that
order, so a shard is compact in every dimension and its files can be pruned by any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from ..operators.numbering import numbered
from ..settings import written
from .batches import free_name
from .rules import let

BITS = 5
ACCURACY = 10_000


def hilbert_index(cell: Column, dims: int, bits: int) -> Column:
    """Place on the curve of an array of ``dims`` whole numbers below ``2 ** bits``: the axes are
    turned level by level into the transposed index, Gray-decoded, and their bits interleaved."""
    turns = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(dims)))
    levels = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1))) if bits > 1 else F.array().cast("array<int>")
    order = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(dims)))

    def turn(x: Column, s: Column) -> Column:
        own, first, low = F.get(x, s["i"]), F.get(x, F.lit(0)), s["q"] - 1
        flip = own.bitwiseAND(s["q"]) != 0
        t = F.when(flip, low).otherwise(first.bitwiseXOR(own).bitwiseAND(low))
        return let(F.struct(t.alias("t"), flip.alias("flip")), lambda z: F.transform(
            x, lambda v, j: F.when((j == 0) | ((j == s["i"]) & ~z["flip"]), v.bitwiseXOR(z["t"])).otherwise(v)))

    def decode(x: Column) -> Column:
        gray = F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0), lambda a, y: a.bitwiseXOR(y)))
        return let(gray, lambda g: let(
            F.aggregate(levels, F.lit(0), lambda a, q: F.when(F.get(g, F.lit(dims - 1)).bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a)),
            lambda t: F.transform(g, lambda v: v.bitwiseXOR(t))))

    def interleave(x: Column) -> Column:
        bit = lambda s: F.when(F.get(x, s["i"]).bitwiseAND(s["q"]) != 0, 1).otherwise(0)
        return F.aggregate(order, F.lit(0).cast("bigint"), lambda a, s: a * 2 + bit(s))

    turned = F.aggregate(turns, cell, turn) if bits > 1 else cell
    return let(let(turned, decode), interleave)


def text_cuts(df: DataFrame, name: str, parts: int) -> list[str]:
    """The texts at ``1 / parts``, ``2 / parts`` ... of the rows in the order of their whole values; ``parts - 1``
    at most. Equal texts are counted first, and only text and count are sorted."""
    column = F.col(f"`{name}`").cast("string")
    counts = df.select(column.alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n")).orderBy("v")
    table = written(counts.withColumn("part", F.spark_partition_id()), "text_counts")
    sizes = table.groupBy("part").agg(F.sum("n").alias("size"))
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    so_far = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per partition of the sorted table: the number of tasks bounds it
    ranked = table.join(F.broadcast(offsets), "part").select("v", "n", (F.col("before") + F.sum("n").over(so_far)).alias("last"))
    total = table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    places = [k * total // parts for k in range(1, parts)] if total else []
    hit = F.filter(F.array(*map(F.lit, places)), lambda p: (p < F.col("last")) & (p >= F.col("last") - F.col("n")))
    return [r["v"] for r in ranked.select("v", F.explode(hit)).collect()] if places else []


def bins(df: DataFrame, names: list[str], bits: int = BITS) -> list[Column]:
    """Bin of each dimension, cut at its quantiles: numbers at approximate ones, texts at exact ones of their
    whole values, so that a common prefix costs nothing. Null is in the first. A bounded number of cut
    points reaches the driver."""
    parts = 1 << bits
    points = F.array(*(F.lit(k / parts) for k in range(1, parts)))
    numeric = [n for n in names if isinstance(df.schema[n].dataType, NumericType)]
    found = [F.percentile_approx(F.col(f"`{n}`").cast("double"), points, ACCURACY) for n in numeric]
    row = df.agg(*(c.alias(f"c{i}") for i, c in enumerate(found))).first() if found else ()
    cut = {n: row[i] or [] for i, n in enumerate(numeric)}
    cut |= {n: text_cuts(df, n, parts) for n in names if n not in cut}

    def place(name: str) -> Column:
        kind = "double" if name in numeric else "string"
        cuts = sorted(cut[name])  # a frequent value repeats or fills several parts, so its neighbours lie far apart
        known = F.array(*map(F.lit, cuts)) if cuts else F.array().cast(f"array<{kind}>")
        return let(F.col(f"`{name}`").cast(kind), lambda m: F.when(m.isNull(), 0).otherwise(F.size(F.filter(known, lambda c: c < m))))

    return [place(name) for name in names]


def hilbert_shards(df: DataFrame, dims: list[str], shards: int, ties: list[Column], bits: int = BITS) -> DataFrame:
    """The columns of ``df`` and ``curve`` (long), ``shard`` (int, from 0) and ``slot`` (long, gapless
    from 0 in each shard, in curve order); such columns are replaced.

    Shards differ by one row at most. Rows of one cell are ordered by ``ties``, which should tell rows
    apart: then a crowded cell is cut like any other run, and only rows equal in all of them may
    change places. Nulls sort first; with fewer rows than shards some shards are empty.
    """
    df = df.drop("curve", "shard", "slot")
    placed = df.withColumn("curve", hilbert_index(F.array(*bins(df, dims, bits)), len(dims), bits))
    rank = free_name("_rank", df.columns)
    ranked = numbered(placed, [F.col("curve").asc(), *(t.asc_nulls_first() for t in ties), F.monotonically_increasing_id()], rank)
    n = ranked.count()
    shard = F.expr(f"CAST({rank} * {int(shards)} DIV {max(1, n)} AS INT)")
    first = F.expr(f"({n} * CAST(shard AS BIGINT) + {int(shards) - 1}) DIV {int(shards)}")
    return ranked.withColumn("shard", shard).withColumn("slot", F.col(rank) - first).drop(rank)


def write_shards(df: DataFrame, path: str) -> None:
    """Write the rows of :func:`hilbert_shards` as Parquet, a folder per shard, in slot order. Rows are
    dealt by shard and a run of slots, so no task holds a whole shard."""
    run = F.floor(F.col("slot") / 1_000_000)
    df.repartition("shard", run).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
