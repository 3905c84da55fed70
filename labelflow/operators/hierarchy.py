"""Taxonomies that come as tables of nodes and their parents.

A taxonomy document must fit one task; a table has no such bound. The paths are found by a recursive query, a
level at a time, so the work is one join per level and no row carries more than its own way up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written

__all__ = ["flatten_nodes", "node_problems", "node_ancestors"]

MAX_LEVELS = 100

# ``seen`` stops a way that would come back to one of its own nodes
_DOWN = """
WITH RECURSIVE way (node, label, description, path, level, parent_path, seen) MAX RECURSION LEVEL {levels} AS (
  SELECT node, label, description, CAST(part AS STRING), 1, CAST(NULL AS STRING), array(node) FROM {{nodes}} WHERE {start}
  UNION ALL
  SELECT n.node, n.label, n.description, concat(way.path, '/', n.part), way.level + 1, way.path, concat(way.seen, array(n.node))
  FROM way JOIN {{nodes}} n ON n.parent = way.node WHERE NOT array_contains(way.seen, n.node)
) SELECT * FROM way"""


def _nodes(nodes: DataFrame) -> DataFrame:
    """``node, parent`` as text, ``label``, ``description`` and the ``part`` of the path; repeated rows once."""
    described = F.col("description").cast("string") if "description" in nodes.columns else F.lit(None).cast("string")
    rows = nodes.select(F.col("node").cast("string"), F.col("parent").cast("string"), F.col("label").cast("string"), described.alias("description"))
    rows = rows.filter(F.col("node").isNotNull()).distinct()
    return rows.withColumn("part", F.replace(F.coalesce("label", "node"), F.lit(" "), F.lit("_")))


def _ways(rows: DataFrame, start: str, max_levels: int) -> DataFrame:
    """All ways down from the rows that fulfil ``start``. The limit on rows, meant for runaway queries, is lifted
    while it runs: ``seen`` and the levels bound the recursion."""
    spark = rows.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return written(spark.sql(_DOWN.format(levels=max_levels + 1, start=start), nodes=rows), "ways")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def flatten_nodes(nodes: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """``node, label, description, path, level, parent_path`` of each way from a root (a node without a parent) to a node.

    ``nodes`` has ``node, parent, label`` and may have ``description``. Blanks in names are ``_`` in the path, as in
    ``flatten_generic``. A node with several parents has a path under each of them. Nodes that no root leads to
    have none and are reported by ``node_problems``. A tree deeper than ``max_levels`` is an error.
    """
    return _ways(written(_nodes(nodes), "nodes"), "parent IS NULL", max_levels).drop("seen")


def node_ancestors(flat: DataFrame) -> DataFrame:
    """``(node, ancestor, distance)`` for all pairs on one way, from the result of ``flatten_nodes``: paths meet
    the paths they begin with by an equi join."""
    steps = F.filter(F.transform(F.sequence(F.lit(1), F.col("level")), lambda i: F.struct(
        F.array_join(F.slice(F.split("path", "/"), 1, i), "/").alias("path"), (F.col("level") - i).alias("distance"))), lambda s: s["distance"] > 0)
    up = flat.filter("level > 1").select("node", F.inline(steps))
    above = flat.select(F.col("node").alias("ancestor"), "path")
    return up.join(above, "path").groupBy("node", "ancestor").agg(F.min("distance").cast("int").alias("distance"))


def node_problems(nodes: DataFrame, max_levels: int = MAX_LEVELS) -> DataFrame:
    """``(node, problem)`` of the nodes that no root leads to: ``unknown parent``, ``below an unknown parent``,
    ``cycle`` and ``below a cycle``; and of nodes on a way from a root that leads back to itself: ``cycle``."""
    rows = written(_nodes(nodes), "nodes")
    known = rows.select(F.col("node").alias("parent")).distinct()
    lost = written(rows.join(known, "parent", "left_anti").filter(F.col("parent").isNotNull()).select("node").distinct(), "lost")
    reached = _ways(rows, "parent IS NULL", max_levels)
    back = reached.join(rows.select("node", F.col("parent").alias("_up")).withColumnRenamed("node", "_down"), F.col("node") == F.col("_up"))
    back = back.filter(F.array_contains("seen", F.col("_down")))
    round_trip = back.select(F.explode(F.slice("seen", F.array_position("seen", F.col("_down")).cast("int"), F.size("seen"))).alias("node"))
    good = reached.select("node").distinct()
    rest = written(rows.join(good, "node", "left_anti"), "unreached")
    fallen = written(rest.join(lost, "node", "left_semi").select("node").distinct(), "fallen")
    told = fallen.withColumn("problem", F.lit("unknown parent"))
    under = fallen
    while True:  # a level at a time
        under = written(rest.join(under.select(F.col("node").alias("parent")), "parent", "left_semi").select("node").distinct().join(told.select("node"), "node", "left_anti"), "under")
        if under.isEmpty():
            break
        told = written(told.unionByName(under.withColumn("problem", F.lit("below an unknown parent"))), "told")
    # what is left is on a cycle or below one: nodes without children are taken off until none is
    ring = written(rest.join(told.select("node"), "node", "left_anti").select("node", "parent"), "ring")
    hanging = ring.select("node").distinct()
    size = -1
    while (now := ring.count()) != size:
        size = now
        ring = written(ring.join(ring.select(F.col("parent").alias("node")).distinct(), "node", "left_semi"), "ring")
    on_ring = ring.select("node").distinct()
    below = hanging.join(on_ring, "node", "left_anti").withColumn("problem", F.lit("below a cycle"))
    cycles = on_ring.unionByName(round_trip).distinct().withColumn("problem", F.lit("cycle"))
    return told.unionByName(below).unionByName(cycles).distinct()
