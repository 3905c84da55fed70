"""Record tables: JSON lines in, column checks, row ids."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = ["RECORD", "read_records", "column_report", "missing_columns", "keep_columns", "with_row_id", "as_records"]

# Expected columns of a record, in order.
RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("domain", T.StringType()),
    T.StructField("metadata", T.StringType()),
])


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType = RECORD) -> DataFrame:
    """Scan JSON lines with a fixed schema, so no inference pass reads the data twice.

    Nested ``metadata`` arrives as JSON text. A line that is no JSON object keeps its raw form
    in ``corrupt_line`` and NULL elsewhere.
    """
    full = T.StructType([*schema.fields, T.StructField("corrupt_line", T.StringType())])
    return (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "corrupt_line")
        .json(path)
    )


def missing_columns(df: DataFrame, expected: list[str] | None = None) -> list[str]:
    have = set(df.columns)
    return [c for c in expected or RECORD.fieldNames() if c not in have]


def column_report(df: DataFrame, expected: list[str] | None = None) -> DataFrame:
    """One row per expected column: ``(column, present, filled)``, with the number of rows that have a
    value; 0 for an absent column. One pass with a map-side combine."""
    want = expected or RECORD.fieldNames()
    missing = set(missing_columns(df, want))
    counts = df.agg(*[F.count(F.lit(None) if c in missing else F.col(f"`{c}`")).alias(c) for c in want])
    rows = [F.struct(F.lit(c).alias("column"), F.lit(c not in missing).alias("present"), F.col(f"`{c}`").alias("filled")) for c in want]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def keep_columns(df: DataFrame, wanted: list[str]) -> tuple[DataFrame, list[str]]:
    """The wanted columns that exist, in the wanted order, and the names that do not."""
    return df.select(*[c for c in wanted if c in df.columns]), missing_columns(df, wanted)


def as_records(df: DataFrame) -> DataFrame:
    """Add absent record columns as typed NULLs, so later steps see one schema; an absent id is made."""
    if "id" not in df.columns:
        df = with_row_id(df)
    for field in RECORD.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df


def with_row_id(df: DataFrame, id_col: str = "id", dense: bool = False, prefix: str = "bookmark_") -> DataFrame:
    """String row id. An existing id is cast.

    Otherwise the id is a hash of ``url`` and ``created_at`` (of the whole row if there is no URL;
    narrow and repeatable, equal for equal values), or, with ``dense``, ``prefix`` + row number, which
    needs one written pass. Rows are numbered in the order of their files and of the places in them;
    a table that was not read from files, in scan order.
    """
    if id_col in df.columns:
        return df.withColumn(id_col, F.col(id_col).cast("string"))
    if not dense:
        named = [c for c in ("url", "created_at") if c in df.columns]
        whole = F.to_json(F.struct(*df.columns))
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in named] if "url" in named else [whole]
        return df.withColumn(id_col, F.sha2(F.concat_ws("\x1f", *parts), 256))
    from ..operators.numbering import numbered

    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))
        placed.schema  # noqa: B018  the columns are looked for here
    except AnalysisException:
        rows = numbered(df, column="_row")
    else:
        # within a block the ids rise in the order of the rows
        placed = placed.withColumn("_place", F.monotonically_increasing_id())
        rows = numbered(placed, [F.col("_file"), F.col("_block"), F.col("_place")], "_row")
    return rows.select(F.concat(F.lit(prefix), F.col("_row").cast("string")).alias(id_col), *df.columns)
