"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..settings import written


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node ``u`` has one edge and no ``v`` is a ``u``: then each component is a star
    around its smallest node."""
    nodes = edges.select(F.col("u").alias("node"), F.lit(1).alias("as_u")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("as_u")).distinct())
    uses = nodes.groupBy("node").agg(F.sum("as_u").alias("edges"), F.count(F.lit(1)).alias("uses"))
    return uses.filter("edges > 1 OR (edges = 1 AND uses > 1)").isEmpty()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the smallest one: the larger neighbours of every node
    (``large``), or the node itself and its smaller neighbours. Both keep the components."""
    if large:
        pairs = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lows = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"), F.count(F.lit(1)).alias("n"))
    total = pairs.count()
    near = join_unique(pairs, lows, "u", "n", total)
    moved = near.filter("v > u" if large else "v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    if not large:
        moved = moved.unionByName(lows.filter("u <> low").select("u", F.col("low").alias("v")))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame, name: str = "edges") -> DataFrame:
    """Columns ``u, v`` in any direction and number; returns one row ``u, v`` per node but the
    smallest of its component, with ``v`` that smallest node. Nodes without an edge don't appear.

    Each round writes the edges to the shared folder, so a lost executor costs one round at most.
    An empty edge table gives an empty result.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), name)
    while not _are_stars(edges):
        edges = written(_star(edges, large=True), name)
        edges = written(_star(edges, large=False), name)
    return edges
