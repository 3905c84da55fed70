"""The inverted file: same answer as all pairs, cells left out, hot cells cut, stored and read again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import sources as S
from labelflow.settings import row_keyed

SCHEMA = "id bigint, vector array<float>"


def clumps(spark, n, groups, seed, spread=0.05, dim=16):
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(groups, dim))
    rng = np.random.default_rng(seed)
    x = middle[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA)


def named(df):
    return df.withColumn("label", F.concat(F.lit("l"), F.lpad(F.col("id").cast("string"), 5, "0"))).drop("id")


def lists(df):
    return {(r["id"], tuple(r["candidate_labels"]), tuple(r["candidate_scores"])) for r in df.collect()}


def test_same_as_all_pairs_and_most_pairs_left_out(spark):
    _, labels = clumps(spark, 900, 30, 1)
    _, records = clumps(spark, 400, 30, 2)
    want = lists(O.attach_nearest(records, named(labels), 7, form="broadcast"))
    assert lists(O.attach_nearest(records, named(labels), 7, form="cells")) == want
    found = O.search_cells(row_keyed(records), named(labels), 7)
    assert found.matches.count() == 400 * 7
    assert found.pairs == 400 * 900 and found.pairs_scored < 0.2 * found.pairs


@pytest.mark.parametrize("k", [1, 40, 1000])
def test_without_structure_and_more_than_all(spark, k):
    rng = np.random.default_rng(3)
    labels = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 5)))], SCHEMA)
    records = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 5)))], SCHEMA)
    assert lists(O.attach_nearest(records, named(labels), k, form="cells")) == lists(O.attach_nearest(records, named(labels), k, form="broadcast"))


def test_hot_cells_are_cut(spark):
    """Nine tenths of the labels and records in one cell, blocks of a few rows."""
    _, many = clumps(spark, 270, 1, 4)
    _, few = clumps(spark, 30, 5, 5)
    labels = many.unionByName(few.withColumn("id", F.col("id") + 1000))
    want = lists(O.attach_nearest(labels, named(labels), 5, form="broadcast"))
    spark.conf.set("spark.labelflow.cellBytes", 8000)
    try:
        assert lists(O.attach_nearest(labels, named(labels), 5, form="cells")) == want
    finally:
        spark.conf.unset("spark.labelflow.cellBytes")


def test_odd_vectors_and_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (None, [-1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [2.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = named(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 5.0]), (4, [0.0, 5.0]), (5, [-1.0, -1.0])], SCHEMA))
    for k in (1, 2, 5):
        assert lists(O.attach_nearest(df, labels, k, form="cells")) == lists(O.attach_nearest(df, labels, k, form="broadcast"))
    none = labels.limit(0)
    assert {r["candidate_labels"] == [] for r in O.attach_nearest(df, none, 3, form="cells").collect()} == {True}
    assert O.attach_nearest(df.limit(0), labels, 3, form="cells").collect() == []


def test_stored_index(spark, tmp_path):
    x, labels = clumps(spark, 500, 20, 6)
    path = str(tmp_path / "ix")
    S.write_index(named(labels).withColumn("path", F.concat(F.lit("p/"), "label")), path, "label", buckets=20, keep=("label", "path"))
    index, table = S.read_index(spark, path), S.read_cells(spark, path)
    cells = O.as_cells(table)
    assert index.count() == 500 == cells.size.sum() and 10 <= len(cells.bucket) <= 20
    for r in index.collect():
        own = cells.bucket.tolist().index(r["bucket"])
        v = np.array(r["vector"])
        angle = np.arccos(np.clip(v @ cells.centre[own] / np.linalg.norm(v), -1, 1))
        assert angle <= cells.radius[own] + 1e-9 and r["norm"] == pytest.approx(np.linalg.norm(v))
    _, records = clumps(spark, 50, 20, 8)
    near = O.attach_nearest(records, index, 3, form="cells", cells=cells)
    assert lists(near) == lists(O.attach_nearest(records, named(labels), 3, form="broadcast"))
    S.write_index(named(labels).limit(10), path, "label", keep=("label",))
    assert S.read_index(spark, path).count() == 10
