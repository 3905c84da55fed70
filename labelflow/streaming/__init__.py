"""The per-record steps on a record stream. Steps that look at other rows (newest copy, counts,
samples, clusters) are batch only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean_text, combine_text, extract_tags, metadata_kind, parse_time
from ..operators.keywords import match_keywords
from ..sources.records import RECORD

__all__ = ["stream_records", "label_stream"]


def stream_records(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """JSON lines files that arrive in a folder."""
    return spark.readStream.schema(schema).json(path)


def label_stream(records: DataFrame, labels: DataFrame, k: int = 5, *, mode: str = "parser",
                 tag_key: str = "raindrop_tags") -> DataFrame:
    """Clean each record and attach keyword labels; no state is kept.

    The label table is static. One beyond the broadcast bound is matched block by block in one pass,
    which holds the matchers of all blocks in each worker.
    """
    cleaned = (
        records.withColumn("cleaned_title", clean_text("title", mode, once=True))
        .withColumn("cleaned_content", clean_text("content", mode, once=True))
        .filter((F.col("cleaned_title") != "") | (F.col("cleaned_content") != ""))
        .withColumn("created_at_dt", parse_time("created_at"))
        .withColumn("combined_text", combine_text("cleaned_title", "cleaned_content"))
        .withColumn("existing_tags", extract_tags("metadata", tag_key, metadata_kind(records.schema["metadata"].dataType) or "json"))
    )
    return match_keywords(cleaned, "combined_text", labels, k, out="assigned_labels")
