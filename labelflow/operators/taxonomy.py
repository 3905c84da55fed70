"""Nested taxonomy documents to a flat label table, and operations on that table.

Label table: ``doc, label, description, path, level, parent_path, pos``. ``pos`` is the list of
positions on the way down, so sorting by it gives document order. ``path`` is the key; ``label``
may repeat.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import ancestor_paths, label_plus_desc
from .skew import salted_join

__all__ = [
    "flatten_taxonomy", "taxonomy_problems", "flatten_generic", "generic_problems", "with_label_text", "first_by_label",
    "repeated_labels", "distinct_labels", "root_labels", "top_level_labels", "closure_table",
]

_MAP = "map<string,string>"


def _is_map(raw: Column) -> Column:
    return F.coalesce(F.ltrim(raw).startswith("{"), F.lit(False))


def _field(raw: Column, name: str) -> Column:
    return F.try_element_at(F.from_json(raw, _MAP), F.lit(name))


def _domains(docs: DataFrame) -> DataFrame:
    """Root entries: ``doc, d, name, raw``."""
    root = docs.select("doc", F.posexplode(F.from_json("body", _MAP)).alias("d", "name", "raw"))
    return root.filter(~F.col("name").startswith("#"))


# Texts for labels without a description.
KINDS = ("Domain", "Subcategory", "Instance")
NOT_DESCRIBED, NOT_DESCRIBED_ITEM = "No description", "No description available"

_LABELS = "doc string, label string, description string, path string, level int, parent_path string, pos array<int>"
_PROBLEMS = "doc string, path string, problem string"
_GENERIC = "doc string, label string, description string, path string, pos int"


def _text(value) -> str | None:
    """A JSON value as text: text as it is, other values in their JSON form."""
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def _parsed(body: str | None):
    """The document, or ``ValueError`` with what is wrong with it."""
    try:
        return json.loads(body or "")
    except (ValueError, RecursionError):
        raise ValueError("document does not parse") from None


class _Nested:
    """One walk over a document of domains, subcategories and instances: labels and problems."""

    def __init__(self, body: str | None):
        self.labels: list[tuple] = []
        self.problems: list[tuple[str, str]] = []
        try:
            root = _parsed(body)
        except ValueError as e:
            self.problems.append(("", str(e)))
            return
        if not isinstance(root, dict):
            self.problems.append(("", "root is no map"))
            return
        for d, (name, domain) in enumerate(root.items()):
            if name.startswith("#"):
                continue
            if not isinstance(domain, dict):
                self.problems.append((name, "domain is no map"))
                continue
            self._label(name, domain, name, 1, None, [d])
            for sub, value, pos in self._entries(domain, "subcategories", name, [d]):
                path = f"{name}/{sub}"
                if not isinstance(value, dict):
                    self.problems.append((path, "subcategory is no map"))
                    continue
                self._label(sub, value, path, 2, name, pos)
                for instance, about, place in self._entries(value, "instances", path, pos):
                    self._label(instance, about, f"{path}/{instance}", 3, path, place)

    def _label(self, name: str, value, path: str, level: int, parent: str | None, pos: list[int]) -> None:
        described = _text(value.get("description")) if isinstance(value, dict) else None
        self.labels.append((name, f"{KINDS[level - 1]}: {name}" if described is None else described, path, level, parent, pos))

    def _entries(self, parent: dict, field: str, path: str, pos: list[int]) -> Iterator[tuple]:
        listed = parent.get(field)
        if not isinstance(listed, list):
            if listed not in (None, "", {}):
                self.problems.append((path, f"{field} is no list"))
            return
        for i, item in enumerate(listed):
            if isinstance(item, dict):
                yield from ((name, value, [*pos, i, j]) for j, (name, value) in enumerate(item.items()))
            else:
                self.problems.append((path, f"{field} item is no map"))


def _per_document(docs: DataFrame, schema: str, rows) -> DataFrame:
    """``rows(body)`` of every document, which is parsed once; documents are read in parallel."""
    names = [f.name for f in T.StructType.fromDDL(schema).fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(doc, *row) for doc, body in zip(batch["doc"], batch["body"]) for row in rows(body)]
            yield pd.DataFrame(found, columns=names)

    return docs.select("doc", "body").mapInPandas(run, schema)


def flatten_taxonomy(docs: DataFrame) -> DataFrame:
    """Three-level flatten with default descriptions; what is of another shape is left out and
    reported by ``taxonomy_problems``."""
    return _per_document(docs, _LABELS, lambda body: _Nested(body).labels)


def taxonomy_problems(docs: DataFrame) -> DataFrame:
    """What the flatten leaves out: ``(doc, path, problem)``. A document that does not parse, or whose
    root is no map, is one row with an empty path."""
    return _per_document(docs, _PROBLEMS, lambda body: _Nested(body).problems)


# -- generic layout ---------------------------------------------------------------------------


def _walk(node, path: str) -> Iterator[tuple[str, str, str]]:
    """Labels below ``node`` in document order, for taxonomies of any depth. Names and descriptions
    that are no text are taken in their JSON form."""
    if isinstance(node, list):
        for n, item in enumerate(node):
            yield from _walk(item, _join(path, f"list_item_{n}"))
    elif isinstance(node, dict):
        for key, value in node.items():
            here = _join(path, key)
            if isinstance(value, dict):
                yield key, _text(value.get("description", NOT_DESCRIBED)), here
                yield from _walk(_without(value, "description", "instances"), here)
            elif isinstance(value, list) and key != "instances":
                for item in value:
                    if isinstance(item, str):
                        yield item, f"{item}, part of {key}", _join(here, item)
                    elif isinstance(item, dict) and item.get("name") is not None:
                        name = _text(item["name"])
                        yield name, _text(item.get("description", NOT_DESCRIBED_ITEM)), _join(here, name)
                        yield from _walk(_without(item, "name", "description"), _join(here, name))
            elif isinstance(value, str) and key != "description":
                yield key, value, here


def _join(path: str, name: str) -> str:
    name = name.replace(" ", "_")
    return f"{path}/{name}" if path else name


def _without(node: dict, *names: str) -> dict:
    return {k: v for k, v in node.items() if k not in names}


def _generic(body: str | None) -> list[tuple]:
    try:
        return [(*entry, i) for i, entry in enumerate(_walk(_parsed(body), ""))]
    except (ValueError, RecursionError):
        return []


def flatten_generic(docs: DataFrame) -> DataFrame:
    """Flatten documents of any depth and shape.

    A label is a map entry, a list item with a ``name``, a plain list item, or a text value. A document
    that does not parse has no labels; ``generic_problems`` reports it.
    """
    return _per_document(docs, _GENERIC, _generic)


def generic_problems(docs: DataFrame) -> DataFrame:
    """Documents that the generic flatten can't read: ``(doc, path, problem)``."""

    def problems(body: str | None) -> list[tuple[str, str]]:
        try:
            list(_walk(_parsed(body), ""))
        except ValueError as e:
            return [("", str(e))]
        except RecursionError:
            return [("", "document is nested too deeply")]
        return []

    return _per_document(docs, _PROBLEMS, problems)


# -- on the label table -----------------------------------------------------------------------

def with_label_text(labels: DataFrame) -> DataFrame:
    return labels.withColumn("label_plus_desc", label_plus_desc("label", "description"))


def first_by_label(labels: DataFrame, key: str = "label", order: str = "pos") -> DataFrame:
    """First label of each name in taxonomy order. The rank filter keeps one row per name and
    partition before the shuffle, so a name repeated very often stays cheap."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(order, "path"))
    return labels.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def repeated_labels(labels: DataFrame) -> DataFrame:
    return labels.groupBy("label").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def distinct_labels(labels: DataFrame) -> DataFrame:
    return labels.select("label").distinct()


def root_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(~F.contains(F.col("path"), F.lit("/")))


def top_level_labels(docs: DataFrame) -> DataFrame:
    """Root entries that are maps with a description."""
    described = _field(F.col("raw"), "description")
    return (
        _domains(docs).filter(_is_map(F.col("raw")) & described.isNotNull())
        .select("doc", F.col("name").alias("label"), described.alias("description"), F.col("name").alias("path"),
                F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent_path"), F.array("d").alias("pos"))
    )


def closure_table(labels: DataFrame) -> DataFrame:
    """``(label, parents)``: names of all ancestors that are labels themselves.

    Ancestor paths meet the label table in an equi join on ``path``, salted because a root is an
    ancestor of very many labels. Where one name stands on several paths its ancestors are united.
    """
    steps = labels.select("label", F.explode(ancestor_paths("path")).alias("path"))
    by_path = labels.select("path", F.col("label").alias("parent"))
    pairs = salted_join(steps, by_path, "path", "label").select("label", "parent").distinct()
    return pairs.groupBy("label").agg(F.array_sort(F.collect_list("parent")).alias("parents"))
