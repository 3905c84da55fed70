import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelflow import operators as O

FORMS = ["inline", "broadcast", "join"]
LABELS = [("A", "A", [0]), ("B", "A/B", [0, 0]), ("C", "A/B/C", [0, 0, 0]), ("D", "D", [1])]


def lists(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id int, l array<string>")


def result(df, column="o"):
    return [r[column] for r in df.orderBy("id").collect()]


@pytest.mark.parametrize("form", FORMS + ["auto"])
def test_closure(spark, form):
    labels = spark.createDataFrame(LABELS, "label string, path string, pos array<int>")
    df = lists(spark, [["C"], ["D", "C"], ["A"], ["Z"], [], None])
    got = result(O.close_hierarchy(df, "id", "l", labels, "o", form=form))
    assert got == [["A", "B", "C"], ["A", "B", "C", "D"], ["A"], ["Z"], [], []]
    again = O.close_hierarchy(O.close_hierarchy(df, "id", "l", labels, "o", form=form), "id", "o", labels, "p", form=form)
    assert result(again, "p") == got


def test_closure_off(spark):
    labels = spark.createDataFrame(LABELS, "label string, path string, pos array<int>")
    assert result(O.close_hierarchy(lists(spark, [["D", "C"], None]), "id", "l", labels, "o", enabled=False)) == [["D", "C"], []]


@pytest.mark.parametrize("form", FORMS)
def test_entities(spark, form):
    labels = spark.createDataFrame([("GitHub",)], "label string")
    df = lists(spark, [["github", "GITHUB", "Foo"], None])
    assert result(O.match_entities(df, "id", "l", labels, "o", form=form)) == [["GitHub"], []]


@pytest.mark.parametrize("form", FORMS)
def test_validation(spark, form):
    labels = spark.createDataFrame([("A",), ("B",), ("A",)], "label string")
    df = lists(spark, [["B", "x", "A", "B"], ["a"], []])
    assert result(O.validate_labels(df, "id", "l", labels, "o", form=form)) == [["B", "A", "B"], [], []]
    assert result(O.unknown_labels(df, "id", "l", labels, "o", form=form)) == [["x"], ["a"], []]


def test_in_row_validation(spark):
    df = spark.createDataFrame([(0, ["B", "x", "B"], ["A", "B"]), (1, None, ["A"]), (2, ["A"], None)], "id int, p array<string>, a array<string>")
    assert result(df.withColumn("o", O.valid_items("p", "a"))) == [["B", "B"], [], []]
    assert result(df.withColumn("o", O.invalid_items("p", "a"))) == [["x"], [], ["A"]]


def test_combine_and_update(spark):
    df = spark.createDataFrame([(0, ["B", "A"], ["A", "C"]), (1, None, ["A"])], "id int, a array<string>, b array<string>")
    assert result(df.withColumn("o", O.combine_lists("a", "b"))) == [["A", "B", "C"], ["A"]]
    base = spark.createDataFrame([(0, -1), (1, -1)], "id int, c int")
    new = spark.createDataFrame([(1, 5)], "id int, c int")
    assert result(O.update_by_key(base, new, "id", "c"), "c") == [-1, 5]


def test_new_labels(spark):
    themes = spark.createDataFrame([("X", ["A", "b"]), (None, None)], "cluster_theme string, subtopics array<string>")
    used = spark.createDataFrame([("A",), ("B",)], "label string")
    assert {r["label"] for r in O.new_label_candidates(themes, used).collect()} == {"X", "b"}
    assert {r["label"] for r in O.new_label_candidates(themes, used, ignore_case=True).collect()} == {"X"}


# -- keywords -------------------------------------------------------------------------------------

def keyword_labels(spark):
    return spark.createDataFrame(
        [("AI_Tools", "Concepts, tools, and so", 0), ("SoftWare", "Building things", 1), ("v0", None, 2), ("Late", "tools, again", 3)],
        "label string, description string, pos int",
    )


@pytest.mark.parametrize("form", ["inline", "automaton", "blocks", "auto"])
def test_keywords(spark, form):
    texts = ["An email about painting", "buy tools, now", "hardWARE v0", "nothing", "", None, "tools without comma"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = result(O.match_keywords(df, "text", keyword_labels(spark), 2, out="o", form=form))
    # "ai" stands in "email"; "tools," needs its comma; the third match is cut by k
    assert got == [["AI_Tools"], ["AI_Tools", "Late"], ["SoftWare", "v0"], [], [], [], ["AI_Tools"]]


def test_whole_words(spark):
    df = spark.createDataFrame([(0, "An email"), (1, "an AI!")], "id int, text string")
    for form in ("inline", "automaton", "blocks"):
        got = result(O.match_keywords(df, "text", keyword_labels(spark), 5, out="o", word_match=True, form=form))
        assert got == [[], ["AI_Tools"]], form


def test_keyword_forms_agree_with_brute_force(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(1, 5)))
    labels = [(f"{word()}_{n}", " ".join(word() for _ in range(3)), n) for n in range(40)]
    # a third of all texts are one copy
    texts = [" ".join(word() for _ in range(rng.randint(0, 4))) for _ in range(60)] + ["abcab cab"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(5)
    frame = spark.createDataFrame(labels, "label string, description string, pos int")
    want = []
    for text in texts:
        hits = [l for l, d, _ in labels if any(t in text for t in [w for w in d.split() if len(w) > 3] + l.split("_"))]
        want.append(hits[:3])
    for form in ("inline", "automaton", "blocks"):
        assert result(O.match_keywords(df, "text", frame, 3, out="o", form=form)) == want, form


def test_overlap(spark):
    df = spark.createDataFrame([(0, "building tools, things"), (1, "zzz"), (2, None)], "id int, text string")
    for form in ("inline", "automaton", "blocks"):
        got = result(O.term_overlap(df, "text", keyword_labels(spark), 2, out="o", form=form))
        assert got == [["AI_Tools", "SoftWare"], [], []] or got == [["SoftWare", "AI_Tools"], [], []]


# -- similarity -----------------------------------------------------------------------------------

def vectors(spark, n, dim, seed, name="id"):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)).round(1)
    return rows, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], f"{name} int, vector array<double>")


@pytest.mark.parametrize("form", ["broadcast", "grid"])
def test_nearest(spark, form):
    a, left = vectors(spark, 50, 4, 1)
    b, right = vectors(spark, 17, 4, 2, "n")
    labels = right.select(F.format_string("L%02d", "n").alias("label"), "vector")
    unit = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit(a) @ unit(b).T, 6)
    want = [[f"L{j:02d}" for j in np.argsort(-row, kind="stable")[:5]] for row in scores]
    spark.conf.set("spark.labelflow.cellBytes", "800")
    try:
        near = O.attach_nearest(left.repartition(3), labels, 5, form=form)
        assert result(near, "candidate_labels") == want
        assert all(s == sorted(s, reverse=True) for s in result(near, "candidate_scores"))
        # more than there are: all of them
        assert {len(x) for x in result(O.attach_nearest(left, labels, 100, form=form), "candidate_labels")} == {17}
    finally:
        spark.conf.unset("spark.labelflow.cellBytes")


def test_nearest_without_vector_or_labels(spark):
    left = spark.createDataFrame([(0, None), (1, [1.0, 0.0])], "id int, vector array<double>")
    labels = spark.createDataFrame([("a", [1.0, 0.0])], "label string, vector array<double>")
    assert result(O.attach_nearest(left, labels, 2), "candidate_labels") == [[], ["a"]]
    assert result(O.attach_nearest(left, labels.limit(0), 2), "candidate_labels") == [[], []]


def test_ties_by_label(spark):
    left = spark.createDataFrame([(0, [1.0, 0.0])], "id int, vector array<double>")
    labels = spark.createDataFrame([(n, [1.0, 0.0]) for n in "dbca"], "label string, vector array<double>")
    for form in ("broadcast", "grid"):
        assert result(O.attach_nearest(left, labels, 2, form=form), "candidate_labels") == [["a", "b"]]


def test_rerank(spark):
    first = spark.createDataFrame([(0, "a", 0.9, 1), (0, "b", 0.8, 5), (0, "c", 0.7, 5)], "id int, label string, score double, x int")
    rows = O.rerank(first, "id", F.col("x"), 2).orderBy("rank").collect()
    assert [r["label"] for r in rows] == ["b", "c"]


# -- one answer whatever the size -----------------------------------------------------------------

def odd_ids(spark, column, values, kind):
    """The values under a repeated id and under no id."""
    ids = ["1", "1", None, "2", None]
    return spark.createDataFrame([(ids[i % 5], i, v) for i, v in enumerate(values)], f"id string, at int, {column} {kind}")


def by_place(df, column="o"):
    return [r[column] for r in df.orderBy("at").collect()]


@pytest.mark.parametrize("form", FORMS + ["auto"])
def test_lookups_treat_each_row_by_itself(spark, form):
    df = odd_ids(spark, "l", [["a"], ["B", "x"], ["A", "b", "A"], None, ["y"]], "array<string>")
    labels = spark.createDataFrame([("A", "A", [0]), ("B", "A/B", [0, 0])], "label string, path string, pos array<int>")
    assert by_place(O.match_entities(df, "id", "l", labels, "o", form=form)) == [["A"], ["B"], ["A", "B"], [], []]
    assert by_place(O.validate_labels(df, "id", "l", labels, "o", form=form)) == [[], ["B"], ["A", "A"], [], []]
    assert by_place(O.unknown_labels(df, "id", "l", labels, "o", form=form)) == [["a"], ["x"], ["b"], [], ["y"]]
    assert by_place(O.close_hierarchy(df, "id", "l", labels, "o", form=form)) == [["a"], ["A", "B", "x"], ["A", "b"], [], ["y"]]


@pytest.mark.parametrize("form", ["inline", "automaton", "blocks", "auto"])
def test_keywords_treat_each_row_by_itself(spark, form):
    df = odd_ids(spark, "text", ["alpha", "beta", "alpha beta", None, "gamma"], "string")
    labels = spark.createDataFrame([("Beta", None, 1), ("Alpha", None, 0)], "label string, description string, pos int")
    spark.conf.set("spark.labelflow.broadcastBytes", "8")  # a block per label
    try:
        assert by_place(O.match_keywords(df, "text", labels, 5, out="o", form=form)) == [["Alpha"], ["Beta"], ["Alpha", "Beta"], [], []]
        assert by_place(O.term_overlap(df, "text", labels, 5, out="o", form=form)) == [["Alpha"], ["Beta"], ["Alpha", "Beta"], [], []]
    finally:
        spark.conf.unset("spark.labelflow.broadcastBytes")


def test_records_are_written_once_for_all_blocks(spark, monkeypatch):
    from labelflow.operators import keywords

    calls, keyed = [], keywords.row_keyed
    monkeypatch.setattr(keywords, "row_keyed", lambda df, column: calls.append(column) or keyed(df, column))
    labels = spark.createDataFrame([(f"Name{n}", "abcdefghijkl"[n] * 4, n) for n in range(12)], "label string, description string, pos int")
    df = spark.createDataFrame([(None, "llll dddd hhhh"), (1, None), (1, ""), (1, "dddd"), (1, "dddd")], "id int, text string")
    want = sorted([["Name3", "Name7"], [], [], ["Name3"], ["Name3"]])
    spark.conf.set("spark.labelflow.broadcastBytes", "40")
    try:
        out = O.match_keywords(df, "text", labels, 2, out="o", form="blocks")
        assert out.columns == ["id", "text", "o"] and sorted(r["o"] for r in out.collect()) == want and len(calls) == 1
    finally:
        spark.conf.unset("spark.labelflow.broadcastBytes")


def test_many_blocks_agree_with_one(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(2, 4)))
    labels = spark.createDataFrame([(f"{word()}_{n}", " ".join(word() for _ in range(4)), n) for n in range(60)], "label string, description string, pos int")
    df = spark.createDataFrame([(i % 7, i, " ".join(word() for _ in range(rng.randint(0, 8)))) for i in range(80)], "id int, at int, text string")
    whole = [by_place(f(df, "text", labels, 3, out="o", form="automaton")) for f in (O.match_keywords, O.term_overlap)]
    spark.conf.set("spark.labelflow.broadcastBytes", "200")
    try:
        assert [by_place(f(df, "text", labels, 3, out="o", form="blocks")) for f in (O.match_keywords, O.term_overlap)] == whole
    finally:
        spark.conf.unset("spark.labelflow.broadcastBytes")


def test_the_matcher_needs_no_package(monkeypatch):
    import sys

    from labelflow.operators.keywords import _matcher

    with_package = _matcher(["ab", "b", "cd"])("xabx")
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    assert _matcher(["ab", "b", "cd"])("xabx") == with_package == {0, 1}


@pytest.mark.parametrize("form", ["broadcast", "grid", "auto"])
def test_nearest_treats_each_row_by_itself(spark, form):
    df = odd_ids(spark, "vector", [[1.0, 0.0], [0.0, 1.0], [1.0, 0.1], None, [0.1, 1.0]], "array<double>")
    labels = spark.createDataFrame([("X", [1.0, 0.0]), ("Y", [0.0, 1.0])], "label string, vector array<double>")
    assert by_place(O.attach_nearest(df, labels, 1, form=form), "candidate_labels") == [["X"], ["Y"], ["X"], [], ["Y"]]


def test_score_matrices_stay_within_the_cell(spark):
    from labelflow.operators.similarity import _slices

    rng = np.random.default_rng(9)
    a, b = rng.normal(size=(1000, 3)), rng.normal(size=(50, 3))
    runs = list(_slices(a, b, 4000))
    assert max(s.nbytes for _, s in runs) <= 4000 and len(runs) == 100
    assert np.allclose(np.concatenate([s for _, s in runs]), a @ b.T, atol=1e-6)
    # a small cell gives several blocks a side, and the same result
    _, left = vectors(spark, 40, 4, 3)
    _, right = vectors(spark, 30, 4, 4, "n")
    labels = right.select(F.format_string("L%02d", "n").alias("label"), "vector")
    want = result(O.attach_nearest(left, labels, 4, form="broadcast"), "candidate_labels")
    spark.conf.set("spark.labelflow.cellBytes", "1000")
    try:
        assert result(O.attach_nearest(left, labels, 4, form="grid"), "candidate_labels") == want
    finally:
        spark.conf.unset("spark.labelflow.cellBytes")


def test_all_that_is_shipped_is_measured(spark):
    from labelflow.operators.similarity import _fits

    labels = spark.createDataFrame([("X", "X", "long " * 5000, [1.0])], "label string, path string, description string, _lv array<double>")
    spark.conf.set("spark.labelflow.broadcastBytes", "10000")
    try:
        assert not _fits(labels, "_lv")
        assert _fits(labels.withColumn("description", F.lit("short")), "_lv")
    finally:
        spark.conf.unset("spark.labelflow.broadcastBytes")


def test_hot_keys_are_spread(spark):
    from labelflow.operators.skew import salted_join

    left = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 2000)).alias("k"))
    right = left.select("k").distinct().filter("k IS NOT NULL").select("k", F.concat(F.lit("v"), "k").alias("v"))
    right = right.unionByName(spark.createDataFrame([("hot", "second")], "k string, v string"))
    for how in ("inner", "left"):
        assert sorted(map(tuple, salted_join(left, right, "k", "id", how).select("id", "k", "v").collect()), key=str) == sorted(
            map(tuple, left.join(right, "k", how).select("id", "k", "v").collect()), key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        sizes = salted_join(left, right, "k", "id").groupBy(F.spark_partition_id()).count().toPandas()["count"]
        assert sizes.max() < 3 * sizes.mean()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
