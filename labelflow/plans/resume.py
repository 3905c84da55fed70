"""Runs in batches that can be taken up again.

``path/data`` has a folder per batch, ``path/log`` a small file per finished one, written last. Only folders that the
log names are read, so what a killed run left behind counts for nothing. Rows are known by their content: a row that was
finished is not done again, in whatever order or batch it comes, and a changed row is a new one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import written

__all__ = ["BatchRun", "run_batches", "finished_batches"]

CONTENT = "content_key"


class BatchRun(NamedTuple):
    rows: DataFrame
    batches_done: int
    rows_done: int
    rows_before: int


def _folder(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def finished_batches(spark: SparkSession, path: str) -> list[dict]:
    """``data`` (folder) and ``rows`` of each finished batch, a file of the log each. A file that was
    cut off names none."""
    fs, log = _folder(spark, f"{path}/log")
    if not fs.exists(log):
        return []
    out = []
    for r in spark.read.text(f"{path}/log", wholetext=True, recursiveFileLookup=True).collect():  # a line per batch
        try:
            out.append(json.loads(r["value"]))
        except ValueError:
            continue
    return out


def _commit(spark: SparkSession, path: str, entry: dict) -> None:
    fs, place = _folder(spark, f"{path}/log/{uuid.uuid4().hex}.json")
    stream = fs.create(place)
    stream.write(bytearray(json.dumps(entry), "utf-8"))
    stream.close()


def _with_content(df: DataFrame) -> DataFrame:
    """A hash of all columns, as text: 256 bits."""
    return df.withColumn(CONTENT, F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256))


def run_batches(df: DataFrame, step: Callable[[DataFrame], DataFrame], path: str, *, batch_rows: int = 500, most: int | None = None) -> BatchRun:
    """Apply ``step`` to the rows of ``df`` in batches of about ``batch_rows`` and store each under ``path`` when it is done.

    ``step`` gets rows with the column ``content_key`` and gives the rows to store, with that column. It works row by
    row: which rows share a batch must not matter. Equal rows are done once and come back as often as they are in ``df``.
    Started again on the same path, the run goes on with the rows that are not done; ``most`` limits the batches
    of this call. One run may write to a path at a time.

    Returns the finished rows of ``df``, with the columns of ``step``, and what was done now and before.
    """
    spark = df.sparkSession
    rows = written(_with_content(df), "batch_rows")
    before = finished_batches(spark, path)
    rest = rows.dropDuplicates([CONTENT])
    if before:
        rest = rest.join(spark.read.parquet(*[b["data"] for b in before]).select(CONTENT), CONTENT, "left_anti")
    rest = written(rest.select(*rows.columns), "rest")
    batches = -(-rest.count() // batch_rows)
    done = 0
    part = F.pmod(F.xxhash64(CONTENT), F.lit(max(1, batches)))
    rest = written(rest.repartitionByRange(part, CONTENT).withColumn("_batch", part).sortWithinPartitions("_batch"), "batches")
    finished = []
    for n in range(batches):
        if most is not None and done == most:
            break
        data = f"{path}/data/{uuid.uuid4().hex}"
        step(rest.filter(F.col("_batch") == n).drop("_batch")).write.parquet(data)
        entry = {"data": data, "rows": spark.read.parquet(data).count()}
        _commit(spark, path, entry)
        finished.append(entry)
        done += 1
    every = before + finished
    if not every:
        return BatchRun(step(rows.limit(0)).drop(CONTENT), 0, 0, 0)
    stored = spark.read.parquet(*[b["data"] for b in every])
    times = rows.groupBy(CONTENT).agg(F.count(F.lit(1)).alias("_times"))
    out = stored.join(times, CONTENT).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).drop("_copy", "_times", CONTENT)
    return BatchRun(out, done, sum(b["rows"] for b in finished), sum(b["rows"] for b in before))
