"""Taxonomy documents as rows ``(doc, body)``, where ``body`` is JSON text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

__all__ = ["read_taxonomy", "yaml_to_json"]


def yaml_to_json(docs: DataFrame) -> DataFrame:
    """Turn YAML bodies into JSON text, file by file, keeping the key order. A body that is no YAML
    stays as it is, so that it is reported as a document that does not parse."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml  # optional: needed on executors only when YAML files are read

        def as_json(text: str) -> str:
            try:
                return json.dumps(yaml.safe_load(text), ensure_ascii=False, default=str)
            except (yaml.YAMLError, TypeError, ValueError, RecursionError):
                return text

        for batch in batches:
            yield pd.DataFrame({"doc": batch["doc"], "body": [as_json(text) for text in batch["body"]]})

    return docs.mapInPandas(convert, "doc string, body string")


def read_taxonomy(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """One row per taxonomy file. ``fmt``: ``json``, ``yaml``, or ``jsonl`` for one document per line."""
    if fmt == "jsonl":
        lines = spark.read.text(path)
        return lines.select(F.sha2("value", 256).alias("doc"), F.col("value").alias("body"))
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("doc"), F.col("value").alias("body")
    )
    if fmt == "json":
        return docs
    if fmt == "yaml":
        return yaml_to_json(docs)
    raise ValueError(f"unknown taxonomy format {fmt!r}")
