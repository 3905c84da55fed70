"""Word joins against all pairs, cluster terms, node tables and observed counts."""

import glob
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import plans as P


def spoken(text):
    return set(re.findall(r"[^\W_]+", (text or "").lower()))


def all_pairs(rows, labels, k, threshold):
    out = Counter()
    for i, t in rows:
        found = []
        for name, path, text in labels:
            a, b = spoken(t), spoken(text)
            share = round(len(a & b) / len(a | b), 6) if a and b else 0
            if share >= round(threshold, 6):
                found.append((-share, name, path))
        out.update((i, n, p, -s, r + 1) for r, (s, n, p) in enumerate(sorted(found)[:k]))
    return out


@pytest.mark.parametrize("threshold", [0.3, 0.8, 1.0])
def test_words_against_all_pairs(spark, threshold):
    rng = random.Random(int(threshold * 10))
    pool = ["the"] * 6 + ["of"] * 4 + [f"w{i}" for i in range(25)]
    texts = [" ".join(rng.choices(pool, k=rng.randint(1, 9))) for _ in range(60)] + ["The, THE the"] * 20 + [None, "", "...", "É é w1"]
    rows = [(i % 70 if i % 9 else None, t) for i, t in enumerate(texts)]
    labels = [(f"l{i % 30:02}", f"p{i}", rng.choice(texts)) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, text string")
    table = spark.createDataFrame(labels, "label string, path string, note string")
    out = O.word_matches(df, table, 4, threshold, label_text="note")
    assert out.columns == ["id", "label", "path", "score", "rank"]
    assert Counter(tuple(r) for r in out.collect()) == all_pairs(rows, labels, 4, threshold)
    if threshold == 1.0:
        assert O.word_matches(df.limit(0), table, 4, 0.5, label_text="note").collect() == []
        with pytest.raises(ValueError):
            O.word_matches(df, table, 4, 0)


def test_pairs_that_are_no_match_are_not_stored(spark):
    from labelflow import settings

    rng = random.Random(3)
    pool = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.sample(pool, 20)) for _ in range(90)] + [" ".join(pool[:n]) for n in (1, 2, 30, 40)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "id int, text string")
    table = df.select(F.format_string("l%03d", "id").alias("label"), "text")
    for bound, n in ((None, len(rows)), ("6000", 60), ("1", 6)):  # one block, blocks of 25 labels, blocks of one
        some = table.filter(F.col("label") < f"l{n:03}")
        want = all_pairs(rows, [(f"l{i:03}", None, t) for i, t in rows[:n]], 3, 0.5)
        start = len(settings._folders)
        if bound:
            spark.conf.set("spark.labelflow.broadcastBytes", bound)
        try:
            assert Counter(tuple(r) for r in O.word_matches(df, some, 3, 0.5, label_text="text").collect()) == want
        finally:
            spark.conf.unset("spark.labelflow.broadcastBytes")
        (stored,) = [f"{f}/word_pairs".removeprefix("file:") for f in settings._folders[start:] if glob.glob(f"{f}/word_pairs")]
        blocks = len(glob.glob(f"{stored}/block=[0-9]*"))
        assert blocks == {None: 1}.get(bound, blocks) and (bound != "1" or blocks == n)
        assert spark.read.parquet(stored).count() <= 3 * len(rows) * blocks


def test_cluster_terms(spark):
    rows = [(0, "the cat the Cat sat"), (0, "the cat"), (1, "the dog ran the race"), (1, "dog"), (-1, "nothing nothing nothing"), (2, None)]
    got = {(r["cluster_id"], r["word"]): (r["count"], r["score"]) for r in O.cluster_terms(spark.createDataFrame(rows, "cluster_id int, text string"), "text", 99).collect()}
    counts = {0: Counter("the cat the cat sat the cat".split()), 1: Counter("the dog ran the race dog".split())}
    mean = sum(sum(c.values()) for c in counts.values()) / 2
    every = counts[0] + counts[1]
    want = {(c, w): (n, round(n / sum(m.values()) * math.log(1 + mean / every[w]), 9)) for c, m in counts.items() for w, n in m.items()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1]) for k in want)
    first = {r["cluster_id"]: r["word"] for r in O.cluster_terms(spark.createDataFrame(rows, "cluster_id int, text string"), "text", 1).collect()}
    assert first == {0: "cat", 1: "dog"}  # not "the", the most frequent word of both


def test_node_tables_agree_with_documents(spark):
    nodes = [("a", None, "Top", "t"), ("b", "a", "Mid dle", None), ("c", "b", "Leaf", "l"), ("d", "a", "Leaf", None), ("d", "b", "Leaf", None), ("c", "b", "Leaf", "l")]
    flat = O.flatten_nodes(spark.createDataFrame(nodes, "node string, parent string, label string, description string"))
    paths = {(r["path"], r["label"], r["level"], r["parent_path"]) for r in flat.collect()}
    assert paths == {("Top", "Top", 1, None), ("Top/Mid_dle", "Mid dle", 2, "Top"), ("Top/Mid_dle/Leaf", "Leaf", 3, "Top/Mid_dle"), ("Top/Leaf", "Leaf", 2, "Top")}
    body = '{"Top": {"description": "t", "Mid dle": {"Leaf": {"description": "l"}}, "Leaf": {}}}'
    docs = O.flatten_generic(spark.createDataFrame([("1", body)], "doc string, body string"))
    assert {(r["path"], r["label"]) for r in docs.collect()} == {p[:2] for p in paths}
    up = {(r["node"], r["ancestor"]): r["distance"] for r in O.node_ancestors(flat).collect()}
    assert up == {("b", "a"): 1, ("c", "b"): 1, ("c", "a"): 2, ("d", "a"): 1, ("d", "b"): 1}


def test_node_problems(spark):
    nodes = [("r", None), ("ok", "r"), ("x", "gone"), ("x1", "x"), ("x2", "x1"), ("p", "q"), ("q", "s"), ("s", "p"), ("t", "p"), ("u", "t"), ("self", "self"), ("back", "ok"), ("ok", "back")]
    got = {(r["node"], r["problem"]) for r in O.node_problems(spark.createDataFrame([(*n, n[0]) for n in nodes], "node string, parent string, label string")).collect()}
    assert got == {
        ("x", "unknown parent"), ("x1", "below an unknown parent"), ("x2", "below an unknown parent"), ("p", "cycle"), ("q", "cycle"), ("s", "cycle"),
        ("self", "cycle"), ("t", "below a cycle"), ("u", "below a cycle"), ("ok", "cycle"), ("back", "cycle")}


def test_rows_and_counts_from_one_scan(spark, tmp_path):
    rows = [(1, "u", "<b>x</b>", "y", "2020-01-01"), (2, "u", "x", None, "2021-01-01"), (3, "v", " ", "<i></i>", "2020-01-01"), (4, "w", "t", "", "never")]
    df = spark.createDataFrame(rows, "id int, url string, title string, content string, created_at string")
    done, counts = P.prepare_counted(df)
    assert {r["stage"]: r["n"] for r in counts.collect()} == {r["stage"]: r["n"] for r in P.preparation_counts(df).collect()}
    assert sorted(r["id"] for r in done.collect()) == [2, 4] == sorted(r["id"] for r in P.prepare(df).collect())
    plan = done._jdf.queryExecution().toString()
    assert "ArrowEvalPython" not in plan  # the written rows are read: nothing is parsed again
    out, told = O.write_counted(df, "t", {"titled": F.trim("title") != "", "none": F.lit(None).cast("boolean")})
    assert [tuple(r) for r in told.collect()] == [("titled", 3, 1), ("none", 0, 4)] and out.count() == 4
    labelled = spark.createDataFrame([(1, ["a", "b"]), (2, None), (3, ["a"])], "id int, labels array<string>")
    names = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    for some in (labelled, labelled.limit(0)):
        assert O.write_with_statistics(some, names, "labels", "r")[1].collect() == O.run_statistics(some, names, "labels", "r").collect()
