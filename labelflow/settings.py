"""Session settings the operators read, and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Upper bounds for data that is shipped to every task. Larger inputs take another form with the same result.
DEFAULTS = {
    "spark.labelflow.broadcastBytes": 64 * 1024 * 1024,
    "spark.labelflow.inlineRows": 64,
    "spark.labelflow.inlineTerms": 256,
    "spark.labelflow.inlineBytes": 1024 * 1024,
    "spark.labelflow.cellBytes": 64 * 1024 * 1024,
}


def setting(spark: SparkSession, name: str) -> int:
    key = f"spark.labelflow.{name}"
    return int(spark.conf.get(key, str(DEFAULTS[key])))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may run without it; a cluster without the setting is an error,
    because a machine-local folder would be lost with its executor.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="labelflow-")
        spark.conf.set("spark.checkpoint.dir", path)
        return path
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


_folders: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    folder = f"{shared_dir(spark)}/labelflow/{uuid.uuid4().hex}"
    _folders.append(folder)
    return f"{folder}/{name}"


def remove_written(spark: SparkSession) -> int:
    """Delete what this process has written to the shared folder so far; returns the number of folders.

    Call it when the results of a run are stored: tables that still wait to be computed read them.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        n += bool(path.getFileSystem(hadoop).delete(path, True))
    return n


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back, which cuts its lineage."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)  # a third less room for texts than with the default
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_together(df: DataFrame, name: str) -> DataFrame:
    """As :func:`written`, for rows whose texts repeat each other (a text, the text cleaned, the text with its title).

    All texts of a row are stored as one list, side by side, so a repeated one takes hardly any room. A reader
    of one text reads all of them.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not texts:
        return written(df, name)
    packed = "_texts"
    while packed.lower() in {c.lower() for c in df.columns}:
        packed = "_" + packed
    table = written(df.select(*[c for c in df.columns if c not in texts], F.array(*texts).alias(packed)), name)
    return table.select(*[F.col(packed)[texts.index(c)].alias(c) if c in texts else c for c in df.columns])


def row_keyed(df: DataFrame, column: str = "_row") -> DataFrame:
    """``df`` with a number of its own for every row, written once so that the numbers hold.

    Operators that take rows apart and join them again use it instead of the caller's id, which may
    repeat or be NULL.
    """
    return written(df.withColumn(column, F.monotonically_increasing_id()), "rows")


def spread(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy stage at least one partition per core.

    A scan of many files already has more partitions and is returned as it is, so no shuffle
    is added on large inputs; a scan of one small file is redistributed round robin.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def measure(df: DataFrame, *columns: str | Column) -> tuple[int, int]:
    """Row count and approximate bytes of ``columns``: one aggregate row reaches the driver."""
    size = F.lit(0).cast("bigint")
    for c in columns:
        text = F.to_json(F.struct(c))
        size = size + F.coalesce(F.octet_length(text), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def salt_values(n: int) -> Column:
    """The numbers ``0 .. n-1`` as a list, to copy a row once per salt or block."""
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))
