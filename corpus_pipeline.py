"""From raw documents to piece ids: quality rules, near-duplicates, decontamination, personal data, pieces.

Each stage takes ``(spark, docs, folder)`` and returns the documents it keeps with their columns, the
last one their pieces. ``run`` writes each result to the shared folder and reads it back as the next
one's input, so a lost executor costs tasks of one stage only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelflow.llm import decontaminate, pieces, pii, rules, simhash
from labelflow.settings import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail."""
    return rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by its kind."""
    return pii.mask_personal(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of all documents (binary, little-endian unsigned 32-bit), their number, and the decoded text."""
    # the stages before have filled the executors' heaps, so the workers get half the room for words
    coded = pieces.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), words=pieces.WORDS // 2, run=1 << 20)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("personal data", masked),
    ("piece encoding", encoded),
]

# SimHash components, fingerprint windows, transducers and merges have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage for the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
