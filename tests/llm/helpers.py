"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
ODD_TEXTS = [None, "", " ", "\n\n", "a", "one two", "É", "日本語 テキスト", "x" * 3000, "the same " * 400, "line\n" * 50, "tab\tand\x0bfeed"]


def documents(spark, texts, extra=None):
    """A documents table; ids from 0. ``extra`` adds a column of that name whose values clash with nothing."""
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F

        df = df.withColumn(extra, F.lit("mine"))
    return df


def repeated_rows(spark, texts):
    """Every row twice, and two rows without an id."""
    df = documents(spark, texts)
    return df.unionByName(df).unionByName(spark.createDataFrame([(None, "no id at all here", None, None, None), (None, None, None, None, None)], DOCS))
