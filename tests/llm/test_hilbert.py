import itertools
import os
import re
from collections import Counter

import pytest
from helpers import ODD_TEXTS, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import hilbert


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 1), (2, 3), (3, 2), (4, 2)])
def test_the_curve_meets_every_cell_and_moves_one_step(spark, dims, bits):
    cells = [(list(c),) for c in itertools.product(range(1 << bits), repeat=dims)]
    df = spark.createDataFrame(cells, "cell array<int>")
    path = sorted((r[1], r[0]) for r in df.select("cell", hilbert.hilbert_index(F.col("cell"), dims, bits)).collect())
    assert [p[0] for p in path] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(x[1], y[1])) == 1 for x, y in zip(path, path[1:]))


def check_law(rows, shards, n):
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == n and (not n or max(sizes.values()) - min(sizes.get(s, 0) for s in range(shards)) <= 1)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_are_equal_runs_of_the_curve(spark):
    df = spark.range(3000).select(
        "id", (F.col("id") % 7).cast("string").alias("lang"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 19)).alias("source"),
        F.when(F.col("id") % 50 > 0, F.col("id") * 37 % 1000).alias("size"), F.lit("mine").alias("shard"))
    rows = hilbert.hilbert_shards(df, ["lang", "source", "size"], 40, [F.col("id")]).collect()
    check_law(rows, 40, 3000)
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in ordered] == sorted(r["curve"] for r in rows)
    assert sorted(r["id"] for r in rows) == list(range(3000))
    # a shard is narrow in several dimensions at once: random shards would have about all 7 languages
    assert sum(len({r["lang"] for r in rows if r["shard"] == s}) for s in range(40)) / 40 < 5
    again = hilbert.hilbert_shards(df.repartition(5), ["lang", "source", "size"], 40, [F.col("id")]).collect()
    assert sorted(again) == sorted(rows)


def test_nulls_ties_few_rows_and_empty_tables(spark):
    docs = repeated_rows(spark, ODD_TEXTS)
    for df, n in ((docs, docs.count()), (docs.limit(3), 3), (docs.limit(0), 0)):
        out = hilbert.hilbert_shards(df, ["lang", "source", "n_chars"], 40, [F.col("doc_id")])
        assert out.columns == [*docs.columns, "curve", "shard", "slot"]
        check_law(out.collect(), 40, n)


def test_written_shards_can_be_read_and_pruned(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") % 10).alias("a"), F.lit("x").alias("b"))
    path = str(tmp_path / "out")
    hilbert.write_shards(hilbert.hilbert_shards(df, ["a", "b"], 8, [F.col("id")]), path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == [f"shard={i}" for i in range(8)]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(400))


def test_no_python_in_the_plan(spark, capsys):
    df = spark.range(100).withColumn("a", F.col("id") % 5)
    hilbert.hilbert_shards(df, ["a"], 4, [F.col("id")]).explain()
    assert not re.search("Python|ArrowEval|Pandas", capsys.readouterr().out)


def test_texts_with_a_common_prefix_fall_into_bins_of_their_own(spark):
    df = spark.range(640).select("id", F.concat(F.lit("https://crawl.example.org/very/long/path/"), F.col("id") % 16).alias("source"))
    source = hilbert.bins(df, ["source"], 5)[0]
    found = df.select("source", source.alias("b")).distinct().collect()
    assert len(found) == 16 and len({r["b"] for r in found}) == 16
    order = [r["b"] for r in sorted(found, key=lambda r: r["source"])]
    assert order == sorted(order)
    mixed = spark.createDataFrame([(None,), ("",), ("a",), ("a",), ("a",), ("b",), ("é",)], "t string")
    assert hilbert.text_cuts(mixed, "t", 3) == ["a", "b"] and sorted(hilbert.text_cuts(mixed, "t", 6)) == ["a", "a", "a", "b", "é"]
    assert hilbert.text_cuts(mixed.limit(0), "t", 3) == []


def test_clashing_columns_and_very_long_texts(spark):
    odd = spark.createDataFrame([(i, "x" * 100_000 + str(i % 3), "mine") for i in range(30)], "id int, t string, _rank string").withColumns({c: F.lit("mine") for c in ("v", "n", "part", "curve", "slot")})
    out = hilbert.hilbert_shards(odd, ["t", "v"], 4, [F.col("id")])
    check_law(out.collect(), 4, 30)
    assert {r["_rank"] for r in out.collect()} == {"mine"} and {r["v"] for r in out.collect()} == {"mine"}
