"""Relations between the nodes of taxonomy documents: edges, problems, and what can be reached."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written
from .taxonomy import _parsed, _per_document, _text

__all__ = ["relation_edges", "relation_problems", "related"]

_EDGES = "doc string, source string, relation string, target string, inherited boolean"


def _named(value, name: str | None) -> Iterator[tuple[str | None, str | None, bool]]:
    """Relation, target and whether the name is inherited, of what a node lists. A bare target has the name of the
    last named one before it in its list."""
    for item in value if isinstance(value, list) else [value]:
        if isinstance(item, dict):
            for name, targets in item.items():
                for k, target in enumerate(targets if isinstance(targets, list) else [targets]):
                    yield name, _text(target), k > 0
        elif item is not None:
            yield name, _text(item), name is not None


def _edges(body: str | None, field: str) -> Iterator[tuple]:
    try:
        waiting = [(None, _parsed(body))]
    except ValueError:
        return
    while waiting:
        name, node = waiting.pop()
        if isinstance(node, dict):
            if name is not None and field in node:
                yield from ((name, *edge) for edge in _named(node[field], None) if edge[1] is not None)
            waiting.extend((k, v) for k, v in node.items() if k != field)
        elif isinstance(node, list):
            waiting.extend((None, v) for v in node)


def relation_edges(docs: DataFrame, field: str = "relationship") -> DataFrame:
    """``(doc, source, relation, target, inherited)`` of every node with ``field``, at any depth.

    The field holds a list of targets under names, ``[{"UsedFor": "A"}, "B"]``: a bare target has the name before it
    (``inherited``), or a NULL relation if there is none. A name may have a list of targets; a single entry needs no
    list. NULL targets are left out. Documents that don't parse have no edges (``taxonomy_problems`` reports them).
    """
    return _per_document(docs, _EDGES, lambda body: _edges(body, field))


def relation_problems(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc, source, relation, target, problem)``: ``no relation`` of targets without a name, and ``unknown target``
    of targets that are no ``label``. An edge may have both."""
    shown = edges.select("doc", "source", "relation", "target")
    known = labels.select(F.col("label").alias("target")).distinct()
    unknown = shown.join(known, "target", "left_anti").select(*shown.columns, F.lit("unknown target").alias("problem"))
    return shown.filter(F.col("relation").isNull()).withColumn("problem", F.lit("no relation")).unionByName(unknown)


def related(edges: DataFrame, max_steps: int = 100) -> DataFrame:
    """``(relation, source, target, distance)``: what each node reaches over edges of one relation, by the fewest steps.

    Edges of all documents form one graph per relation; NULL relations are left out, and cycles end by themselves (a node on one
    reaches itself). Each round joins only the pairs found last with the edges and is written, so there is one
    join per step of the longest way. Ways of over ``max_steps`` steps are not followed.
    """
    key = ["relation", "source", "target"]
    step = written(edges.filter("relation IS NOT NULL").select(*key).distinct(), "edges")
    on = step.select("relation", F.col("source").alias("target"), F.col("target").alias("_next"))
    found = last = step.withColumn("distance", F.lit(1))
    for k in range(2, max_steps + 1):
        further = last.join(on, ["relation", "target"]).select("relation", "source", F.col("_next").alias("target")).distinct()
        last = written(further.join(found, key, "left_anti").withColumn("distance", F.lit(k)), "reached")
        if last.isEmpty():
            break
        found = found.unionByName(last)
    return found
