import json
import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from labelflow import operators as O


def edges_of(spark, *bodies):
    rows = [(str(i), b if b is None or isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
    return O.relation_edges(spark.createDataFrame(rows, "doc string, body string"))


def test_names_are_inherited_within_a_list(spark):
    tool = {"type": "Tool", "relationship": [{"UsedFor": "A"}, "B", {"PartOf": ["C", "D"], "Is": None}, 7, None]}
    deep = {"Area": {"subcategories": [{"Sub": {"instances": [{"Tool": tool}, {"Bare": {"relationship": ["X", {"UsedFor": "Y"}]}}]}}]},
            "One": {"relationship": {"PartOf": "Area"}}, "Text": {"relationship": "Z"}, "None": {"relationship": None}}
    got = {(r["source"], r["relation"], r["target"], r["inherited"]) for r in edges_of(spark, deep, "no json", None, "", "[]", "3").collect()}
    assert got == {
        ("Tool", "UsedFor", "A", False), ("Tool", "UsedFor", "B", True), ("Tool", "PartOf", "C", False), ("Tool", "PartOf", "D", True), ("Tool", "Is", "7", True),
        ("Bare", None, "X", False), ("Bare", "UsedFor", "Y", False), ("One", "PartOf", "Area", False), ("Text", None, "Z", False)}
    labels = spark.createDataFrame([("A",), ("B",), ("C",), ("Area",), ("X",), ("X",), (None,)], "label string")
    told = {(r["source"], r["target"], r["problem"]) for r in O.relation_problems(edges_of(spark, deep), labels).collect()}
    assert told == {("Bare", "X", "no relation"), ("Text", "Z", "no relation"), ("Text", "Z", "unknown target"), ("Tool", "D", "unknown target"),
                    ("Tool", "7", "unknown target"), ("Bare", "Y", "unknown target")}


def test_reach_is_by_relation_with_fewest_steps_and_ends_on_cycles(spark):
    rng = random.Random(5)
    rows = [("d", str(rng.randrange(25)), rng.choice(["a", "b", None]), str(rng.randrange(25)), False) for _ in range(90)]
    rows += rows[:5] + [("d", "s", "a", "s", False)]
    got = sorted(map(tuple, O.related(spark.createDataFrame(rows, O.relations._EDGES)).collect()))
    want = []
    for relation in ("a", "b"):
        out = {}
        for _, s, r, t, _ in rows:
            if r == relation:
                out.setdefault(s, set()).add(t)
        for source in out:
            far, waiting = {}, deque((t, 1) for t in out[source])
            while waiting:
                node, k = waiting.popleft()
                if node not in far:
                    far[node] = k
                    waiting.extend((t, k + 1) for t in out.get(node, ()))
            want += [(relation, source, t, k) for t, k in far.items()]
    assert got == sorted(want)
    chain = spark.createDataFrame([("d", str(i), "a", str(i + 1), False) for i in range(9)], O.relations._EDGES)
    assert O.related(chain, max_steps=3).agg(F.max("distance")).first()[0] == 3
    assert O.related(chain.limit(0)).count() == 0


def numbers(spark, n):
    return spark.range(n).select(
        (F.col("id") % 7).cast("string").alias("day"), F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(30_000))).alias("x"),
        F.when(F.col("id") % 100 < 40, F.lit("often")).otherwise(F.col("id").cast("string")).alias("y"), F.lit(float("nan")).alias("z"))


def test_merged_sketches_keep_their_error_bounds(spark):
    df = numbers(spark, 60_000).cache()
    parts = O.sketch_columns(df, ["x", "y", "z"], F.col("day"))
    assert parts.count() == 21
    rows = {r["column"]: r for r in O.sketch_summary(O.merge_sketches(parts), (0.0, 0.25, 0.5, 0.9)).collect()}
    once = {r["column"]: r for r in O.sketch_summary(O.sketch_columns(df)).collect()}
    assert set(once) == {"day", "x", "y", "z"} and once["x"]["n"] == 60_000 == rows["x"]["n"] and once["x"]["part"] is None
    assert rows["x"]["nulls"] == 12_000 and rows["z"]["nulls"] == 0 and rows["z"]["quantiles"] is None and rows["y"]["low"] is None
    exact = df.agg(F.min("x"), F.max("x"), F.count_distinct("x"), F.count_distinct("y")).first()
    assert (rows["x"]["low"], rows["x"]["high"]) == (exact[0], exact[1])
    for column, n in (("x", exact[2]), ("y", exact[3])):
        assert abs(rows[column]["n_distinct"] - n) <= 0.05 * n
    for q, value in zip((0.25, 0.5, 0.9), rows["x"]["quantiles"][1:]):
        assert abs(df.filter(F.col("x") <= value).count() / 48_000 - q) < 0.03
    assert rows["y"]["top"][0]["item"] == "often" and abs(rows["y"]["top"][0]["count"] - 24_000) < 600
    df.unpersist()


def test_long_values_clashing_names_and_empty_tables(spark):
    df = spark.createDataFrame([("v" * 5000, "p", [1]), ("v" * 5000, "p", [2]), (None, "q", None)], "value string, part string, list array<int>")
    rows = {r["column"]: r for r in O.sketch_summary(O.sketch_columns(df)).collect()}
    assert set(rows) == {"value", "part"} and rows["value"]["nulls"] == 1 and rows["value"]["n_distinct"] == 1
    assert [(len(s["item"]), s["count"]) for s in rows["value"]["top"]] == [(64, 2)]
    assert O.sketch_columns(df.limit(0)).count() == 0 == O.merge_sketches(O.sketch_columns(df.limit(0))).count()


def test_a_part_taken_again_counts_once(spark, tmp_path):
    df, path = numbers(spark, 700), str(tmp_path / "sketches")
    O.store_sketches(O.sketch_columns(df, part=F.col("day")), path)
    O.store_sketches(O.sketch_columns(df.filter("day = '3'"), part=F.col("day")), path)
    O.store_sketches(O.sketch_columns(df.filter("day = '4'"), part=F.lit("07")), path)
    stored = O.read_sketches(spark, path)
    assert {r[0] for r in stored.select("part").distinct().collect()} == {*map(str, range(7)), "07"}
    assert {r["n"] for r in O.merge_sketches(stored).collect()} == {800}
    assert {r["n"] for r in O.merge_sketches(stored.filter("part = '3'")).collect()} == {100}
