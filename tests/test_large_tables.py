"""What must hold when tables are large: forms give way at their bounds, and no step grows faster than its input."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from labelflow import operators as O


# -- lookups -------------------------------------------------------------------------------------

def _names(spark, n):
    return spark.range(n).select(F.concat(F.lit("Name "), F.col("id").cast("string")).alias("label"))


def _lists(spark, n):
    said = F.array(F.concat(F.lit("NAME "), F.col("id").cast("string")), F.lit("none such"), F.lit(None).cast("string"))
    return spark.range(n).groupBy("id").agg(F.first(said).alias("said"))


def test_inline_lookup_puts_no_table_into_the_rows_and_no_long_map(spark):
    found = O.match_entities(_lists(spark, 40), "id", "said", _names(spark, 300), "found", form="inline")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and "_map" not in plan and "Python" not in plan
    assert {r["id"]: r["found"] for r in found.collect()} == {i: [f"Name {i}"] for i in range(40)}


@pytest.mark.parametrize("bounds", [{}, {"inlineBytes": 100}, {"inlineBytes": 100, "broadcastBytes": 100}])
def test_inline_lookup_gives_way_beyond_its_bounds(spark, bounds):
    labels = _names(spark, 50).unionByName(spark.createDataFrame([(None,), ('quoted "é\n',)], "label string"))
    rows = spark.createDataFrame([(1, ["Name 3", 'quoted "é\n', "x", None]), (None, None), (1, [])], "id int, said array<string>")
    for k, v in bounds.items():
        spark.conf.set(f"spark.labelflow.{k}", v)
    try:
        valid = O.validate_labels(rows, "id", "said", labels, "valid", form="inline")
        told = O.unknown_labels(valid, "id", "said", labels, "unknown", form="inline")
        got = sorted((r["id"] or 0, r["valid"], r["unknown"]) for r in told.collect())
    finally:
        for k in bounds:
            spark.conf.unset(f"spark.labelflow.{k}")
    assert got == [(0, [], []), (1, [], []), (1, ["Name 3", 'quoted "é\n'], ["x"])]


# -- nearest labels ------------------------------------------------------------------------------

def test_labels_of_one_vector_are_scored_once(spark, monkeypatch):
    from labelflow.operators import similarity

    seen = []
    near = similarity._near_udf
    monkeypatch.setattr(similarity, "_near_udf", lambda labels, k: seen.append(labels.count()) or near(labels, k))
    labels = spark.range(500).select(
        F.format_string("L%03d", "id").alias("label"), F.when(F.col("id") % 2 == 0, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(2.0))).alias("vector"))
    rows = spark.createDataFrame([(1, [3.0, 0.0]), (1, [1.0, 2.0]), (None, None)], "id int, vector array<double>")
    got = sorted(r["candidate_labels"] for r in O.attach_nearest(rows, labels, 3, form="broadcast").collect())
    assert got == [[], ["L000", "L002", "L004"], ["L001", "L003", "L005"]] and seen == [6]
    for form in ("grid", "cells"):
        assert sorted(r["candidate_labels"] for r in O.attach_nearest(rows, labels, 3, form=form).collect()) == got


# -- vectors of texts ----------------------------------------------------------------------------

def test_vectors_are_made_in_runs_of_words(spark, monkeypatch):
    from labelflow.operators import vectors

    rows = spark.createDataFrame([(i, " ".join(f"w{j % 7}" for j in range(i % 30)) if i % 11 else None) for i in range(300)], "id int, text string")

    def made():
        return {r["id"]: r["vector"] for r in O.embed_text(rows, "text", 8).collect()}

    whole = made()
    assert vectors.RUN_WORDS > 1
    monkeypatch.setattr(vectors, "RUN_WORDS", 10)
    assert made() == whole


# -- resumed runs --------------------------------------------------------------------------------

def test_rows_of_one_batch_go_to_many_tasks(spark, monkeypatch, tmp_path):
    from labelflow.plans import resume

    parts, write = {}, resume.written
    monkeypatch.setattr(resume, "written", lambda df, name: parts.setdefault(name, df.rdd.getNumPartitions()) and write(df, name))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run = resume.run_batches(spark.range(1000), lambda rows: rows, str(tmp_path / "run"), batch_rows=1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert (run.batches_done, run.rows.count()) == (1, 1000) and parts["batches"] > 1
