"""Clean, filter, date, de-duplicate and join up the text of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import clean_text, combine_text, empty_strings, extract_tags, metadata_kind, parse_time
from ..operators.dedup import keep_newest, observed_counts
from ..settings import written
from ..sources.records import as_records

__all__ = ["prepare", "prepare_counted", "clean_records", "preparation_counts", "FLAT_COLUMNS"]

# Columns of the flat output, in order.
FLAT_COLUMNS = [
    "id", "url", "source", "title", "content", "created_at", "domain", "metadata", "cleaned_title", "cleaned_content",
    "created_at_dt", "combined_text", "existing_tags",
]


def clean_records(records: DataFrame, mode: str = "parser") -> DataFrame:
    """Add cleaned texts and the date; drop records whose texts are both empty.

    A record with neither title nor content is dropped before the parser sees it.
    """
    some = records.filter(
        (F.trim(F.coalesce("title", F.lit(""))) != "") | (F.trim(F.coalesce("content", F.lit(""))) != "")
    )
    cleaned = (
        some.withColumn("cleaned_title", clean_text("title", mode, once=True))
        .withColumn("cleaned_content", clean_text("content", mode, once=True))
        .withColumn("created_at_dt", parse_time("created_at"))
    )
    return cleaned.filter((F.col("cleaned_title") != "") | (F.col("cleaned_content") != ""))


def preparation_counts(records: DataFrame, mode: str = "parser") -> DataFrame:
    """What becomes of the rows on the way to ``prepare``: ``(stage, n)`` for rows read, empty ones,
    later copies of a URL, rows without a valid date, and rows that are left. For counts alone; who
    stores the prepared rows as well gets both from ``prepare_counted``, which parses the texts once."""
    df = as_records(records)
    told = df.select(
        "url", parse_time("created_at").alias("at"),
        ((clean_text("title", mode) != "") | (clean_text("content", mode) != "")).alias("ok"))
    by_url = told.groupBy("url").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("some"), F.count_if(F.col("ok") & F.col("at").isNull()).alias("undated"))
    left = F.count_if(F.col("some") > 0)
    sums = {
        "read": F.sum("n"), "empty": F.sum(F.col("n") - F.col("some")), "invalid_dates": F.sum("undated"),
        "duplicates": F.sum("some") - left, "prepared": left,
    }
    rows = [F.struct(F.lit(name).alias("stage"), F.coalesce(n, F.lit(0)).cast("bigint").alias("n")) for name, n in sums.items()]
    return by_url.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def prepare(records: DataFrame, *, mode: str = "parser", tag_key: str = "raindrop_tags", dedupe: bool = True) -> DataFrame:
    """Records to one row per URL with ``combined_text`` and ``existing_tags``."""
    return _finished(clean_records(as_records(records), mode), tag_key, dedupe)


def prepare_counted(
    records: DataFrame, *, mode: str = "parser", tag_key: str = "raindrop_tags", dedupe: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The prepared rows, written, and the counts of :func:`preparation_counts`, from one scan and one run of the parser.

    The counts are observed while rows are written. Both writes end the stage that is observed: there a lost
    task is counted once when it is run again, while a stage before a shuffle may be run and counted twice.
    So the cleaned rows are written before the newest are picked from them.
    """
    read, some, left = Observation(), Observation(), Observation()
    source = as_records(records).observe(read, F.count(F.lit(1)).alias("n"))
    undated = F.count_if(F.col("created_at_dt").isNull())
    cleaned = written(clean_records(source, mode).observe(some, F.count(F.lit(1)).alias("n"), undated.alias("undated")), "cleaned")
    out = written(_finished(cleaned, tag_key, dedupe).observe(left, F.count(F.lit(1)).alias("n")), "prepared")
    counts = {
        "read": read.get["n"], "empty": read.get["n"] - some.get["n"], "invalid_dates": some.get["undated"],
        "duplicates": some.get["n"] - left.get["n"], "prepared": left.get["n"],
    }
    return out, observed_counts(records.sparkSession, counts)


def _finished(cleaned: DataFrame, tag_key: str, dedupe: bool) -> DataFrame:
    unique = keep_newest(cleaned, "url", "created_at_dt") if dedupe else cleaned
    kind = metadata_kind(unique.schema["metadata"].dataType)
    tags = extract_tags("metadata", tag_key, kind) if kind else empty_strings()
    out = unique.withColumn("combined_text", combine_text("cleaned_title", "cleaned_content")).withColumn("existing_tags", tags)
    return out.select(*FLAT_COLUMNS, *[c for c in out.columns if c not in FLAT_COLUMNS])
