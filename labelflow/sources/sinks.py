"""Writers. Each writes one directory of part files, so no row passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "list_literal", "flat_columns", "write_csv", "json_ready", "write_json_lines", "write_suggestions", "SUGGESTION_COLUMNS",
    "run_manifest", "write_manifest", "write_index", "read_index", "read_cells",
]

# Column-name parts left out of the flat file, and the suggestion columns in order.
CSV_SKIP = ("metadata", "_scores", "_paths")
SUGGESTION_COLUMNS = [
    "cluster_id", "cluster_size", "potential_new_entities", "thematic_gap_suggestions", "assigned_labels_in_cluster",
]


def list_literal(c: str | Column) -> Column:
    """A list of text in brackets with quoted items, ``['a', "it's"]``."""
    items = F.col(c) if isinstance(c, str) else c

    def quoted(x: Column) -> Column:
        body = x
        for old, new in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            body = F.replace(body, F.lit(old), F.lit(new))
        double = F.contains(x, F.lit("'")) & ~F.contains(x, F.lit('"'))
        single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
        return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)

    return F.concat(F.lit("["), F.array_join(F.transform(items, quoted), ", "), F.lit("]"))


def flat_columns(
    df: DataFrame, skip: tuple[str, ...] = CSV_SKIP, separator: str = ", ", literals: bool = False
) -> DataFrame:
    """Drop columns whose name holds a skipped part; arrays become delimited text, or bracketed
    list literals."""
    out = []
    for field in df.schema.fields:
        if any(part in field.name for part in skip):
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType):
            texts = c.cast("array<string>")
            c = list_literal(texts) if literals else F.array_join(texts, separator)
        elif isinstance(field.dataType, (T.MapType, T.StructType, T.VariantType)):
            c = F.to_json(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, skip: tuple[str, ...] = CSV_SKIP, literals: bool = False, compression: str = "none") -> None:
    """CSV with a header. For the flat output of replies use ``skip=(), literals=True``."""
    (
        flat_columns(df, skip, literals=literals).write.mode("overwrite")
        .option("header", True).option("escape", '"').option("emptyValue", "").option("compression", compression)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSSxxx").csv(path)
    )


def json_ready(df: DataFrame) -> DataFrame:
    """Timestamps as ISO text with offset; variants as JSON text."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
        elif isinstance(field.dataType, T.VariantType):
            c = F.to_json(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One object per line, UTF-8 as it is, NULL fields kept."""
    json_ready(df).write.mode("overwrite").option("ignoreNullFields", "false").option("compression", compression).json(path)


def write_suggestions(suggestions: DataFrame, path: str) -> None:
    have = [c for c in SUGGESTION_COLUMNS if c in suggestions.columns]
    write_json_lines(suggestions.select(*have), path)


def run_manifest(enriched: DataFrame, files: dict[str, str], run_id: str, label_stats: DataFrame | None = None) -> DataFrame:
    """One-row run summary: id, row total, label total (when statistics exist), files written."""
    totals = enriched.agg(F.count(F.lit(1)).alias("total_records"))
    if label_stats is not None:
        totals = totals.withColumn("total_unique_labels", label_stats.agg(F.count(F.lit(1))).scalar())
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("path")) for n, p in files.items()])
    return totals.select(F.lit(run_id).alias("run_id"), *totals.columns, listed.alias("files_created"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.coalesce(1).write.mode("overwrite").json(path)


def write_index(
    vectors: DataFrame, path: str, key: str, vector: str = "vector", *, buckets: int | None = None, keep: tuple[str, ...] = (),
) -> None:
    """Two tables; a new run replaces the old ones: ``vectors`` (``key, vector, norm, bucket`` and the columns to ``keep``)
    and ``cells`` (``bucket, centre, radius, size``), an inverted file that ``attach_nearest`` can search.

    Vectors are stored in order of ``bucket``, so a reader that wants some of them skips the row groups of
    others; a large bucket spans several files. Rows without a vector are left out.
    """
    from ..operators.cells import cell_table, with_buckets

    v = F.col("vector")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), *keep)
    placed, centres = with_buckets(rows, "key", "vector", buckets)
    stored = placed.select("key", "vector", norm.alias("norm"), "bucket", "angle", *keep)
    stored.repartitionByRange("bucket", F.xxhash64("key")).sortWithinPartitions("bucket").write.mode("overwrite").parquet(f"{path}/vectors")
    cell_table(read_index(vectors.sparkSession, path), centres).write.mode("overwrite").parquet(f"{path}/cells")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/vectors")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/cells")
