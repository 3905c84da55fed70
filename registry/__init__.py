"""Queries over the given tables, one or more per operator, each with the SQL it must agree with.

Names start with the operator id. Lists are joined to text and floats rounded, so that results
can be compared as plain values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one scale, read when first used: ``t.documents``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under ``name``."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load() -> None:
    from . import aggregates, matching, models, plans, records, taxonomies  # noqa: F401
