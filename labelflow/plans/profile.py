"""Data profile of a record table."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ..functions import text_length
from ..operators.stats import column_info, null_counts, numeric_summary, top_values, value_counts

__all__ = ["Profile", "profile"]


class Profile(NamedTuple):
    columns: DataFrame
    nulls: DataFrame
    lengths: DataFrame
    values: dict[str, DataFrame]
    top: dict[str, DataFrame]


def profile(df: DataFrame, *, texts: tuple[str, ...] = ("title", "content"), categories: tuple[str, ...] = ("source",),
            ranked: tuple[str, ...] = ("domain",), n: int = 10) -> Profile:
    """Column types and NULLs, text lengths, value counts and the ``n`` most frequent values."""
    lengths = df.select(*[text_length(c).cast("bigint").alias(f"{c}_length") for c in texts if c in df.columns])
    return Profile(
        column_info(df), null_counts(df), numeric_summary(lengths),
        {c: value_counts(df, c) for c in categories if c in df.columns},
        {c: top_values(df, c, n) for c in ranked if c in df.columns},
    )
