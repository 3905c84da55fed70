"""Names a letter apart, labels that occur together, runs taken up again."""

import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import plans as P


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_fuzzy_pairs_against_all_pairs(spark, distance):
    rng = random.Random(distance)
    words = ["", "a", "é"] + ["".join(rng.choices("abé", k=rng.randint(1, 9))) for _ in range(120)]
    names, targets = words[:70] * 2 + [None], words[50:] + [None]
    got = Counter(tuple(r) for r in O.fuzzy_pairs(
        spark.createDataFrame([(w,) for w in names], "name string"), spark.createDataFrame([(w,) for w in targets], "target string"), distance).collect())
    want = Counter((a, b, edits(a, b)) for a in set(names) - {None} for b in set(targets) - {None} if edits(a, b) <= distance)
    assert got == want


def test_fuzzy_entities(spark):
    rows = [(1, ["Pythn", "JAVA", None]), (1, ["rust", "nothing like it"]), (None, None), (2, [])]
    labels = spark.createDataFrame([("Python",), ("Java",), ("Lava",), ("Rust",), ("Rusty",), ("Rust",)], "label string")
    out = O.match_entities_fuzzy(spark.createDataFrame(rows, "id int, e array<string>"), "e", labels, "found", 1)
    assert Counter((r["id"], tuple(r["found"])) for r in out.collect()) == Counter([(1, ("Java", "Python")), (1, ("Rust",)), (None, ()), (2, ())])


@pytest.mark.parametrize("least, chunk", [(1, 64), (1, 2), (3, 3)])
def test_label_pairs(spark, least, chunk):
    rng = random.Random(least)
    lists = [rng.choices("abcdefgh", k=rng.randint(0, 12)) for _ in range(40)] + [None, [], ["a"], ["a", "a", None, "b"]] + [["a", "c"]] * 20
    out = O.label_pairs(spark.createDataFrame([(x,) for x in lists], "l array<string>"), "l", least, chunk)
    single, both = Counter(), Counter()
    for x in lists:
        own = sorted(set(x or []) - {None})
        single.update(own)
        both.update(combinations(own, 2))
    want = {(a, b): (n, single[a], single[b], round(n * len(lists) / (single[a] * single[b]), 6)) for (a, b), n in both.items() if n >= least}
    assert {(r["label_a"], r["label_b"]): tuple(r)[2:] for r in out.collect()} == want


def test_a_killed_run_goes_on(spark, tmp_path):
    path = str(tmp_path / "run")
    rows = [(i, f"text {i}") for i in range(40)] + [(7, "text 7"), (None, None), (None, None)]
    df = spark.createDataFrame(rows, "id int, t string")
    calls = []

    def step(batch):
        calls.append(batch.count())
        if len(calls) == 3:
            raise RuntimeError("killed")
        return batch.select("content_key", "id", F.upper("t").alias("u"))

    want = Counter((i, None if t is None else t.upper()) for i, t in rows)
    with pytest.raises(RuntimeError):
        P.run_batches(df, step, path, batch_rows=8)
    assert len(P.finished_batches(spark, path)) == 2
    # a batch half written, and a log entry cut off
    spark.createDataFrame([("x", 1, "HALF")], "content_key string, id int, u string").write.parquet(f"{path}/data/half")
    (tmp_path / "run/log/cut.json").write_text('{"data": "')
    done = P.run_batches(df.repartition(3), step, path, batch_rows=8)
    assert Counter(tuple(r) for r in done.rows.collect()) == want
    assert done.rows_before == sum(calls[:2]) and done.rows_done + done.rows_before == 41  # no row twice
    more = P.run_batches(df.filter("id <> 3").unionByName(spark.createDataFrame([(3, "changed")], "id int, t string")), step, path, batch_rows=8)
    assert (more.batches_done, more.rows_done) == (1, 1)
    assert (3, "CHANGED") in {tuple(r) for r in more.rows.collect()} and more.rows.count() == 41
    n = len(calls)
    same = P.run_batches(df, step, path)
    assert same.batches_done == 0 and len(calls) == n and Counter(tuple(r) for r in same.rows.collect()) == want


def test_empty_run(spark, tmp_path):
    df = spark.createDataFrame([], "id int, t string")
    none = P.run_batches(df, lambda b: b.select("content_key", "id"), str(tmp_path / "none"))
    assert none.rows.collect() == [] and none.rows.columns == ["id"] and none.batches_done == 0
