"""Findings of round 4: word joins by lengths, stored results, nearest vectors."""

import glob
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import settings
from labelflow.operators import token_join


@pytest.mark.parametrize("threshold", [0.05, 0.4, 0.8, 1.0])
def test_few_sets_meet_beside_those_that_match(threshold):
    rng = np.random.default_rng(4)
    common = np.sort(3000 - (3000 * rng.random((160, 120)) ** 3).astype(int), axis=1)  # rare words first
    sets = [np.unique(s[: rng.integers(1, 120)]).astype(np.int32) for s in common]
    sets += [np.unique(np.append(s[3:], 3001 + i)).astype(np.int32) for i, s in enumerate(sets[:60]) if len(s) > 3]
    n = np.array([len(s) for s in sets])
    block = pa.table({"set": np.arange(len(sets)), "n": n, "ids": pa.array([s.tolist() for s in sets], pa.list_(pa.int32()))})
    index = token_join._index(block, threshold)
    starts, ids = np.cumsum(n) - n, np.concatenate(sets)
    met = {(int(r), int(index.number[m])) for rows, sets_ in token_join._met(index, ids, starts, n, threshold) for r, m in zip(rows, sets_)}
    share = lambda a, b: round(len(np.intersect1d(a, b)) / len(np.union1d(a, b)), 6)
    match = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if share(a, b) >= threshold}
    assert match <= met
    assert threshold < 0.4 or len(met - match) < len(sets) ** 2 // 50
    table = np.full(token_join.PLACES, -1, np.int32)
    every = np.arange(len(sets))
    best = {(i, int(b), s) for i, a in enumerate(sets[:40]) for b, s in zip(*token_join._best(index, a, table, every, len(sets), threshold))}
    assert best == {(i, j, round(share(sets[i], sets[j]) * 10**6)) for i, j in match if i < 40} and (table == -1).all()


def test_words_are_numbered_where_they_lie(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(30))) for i in range(30)]
    df = spark.createDataFrame(rows + rows[:9], "id int, text string")
    labels = df.select(F.format_string("l%02d", "id").alias("label"), "text")
    want = None
    for bound in (None, "8000", "1"):  # all words shipped, the frequent ones, none
        start = len(settings._folders)
        if bound:
            spark.conf.set("spark.labelflow.broadcastBytes", bound)
        try:
            got = sorted(map(tuple, O.word_matches(df, labels, 3, 0.3, label_text="text").collect()), key=str)
        finally:
            spark.conf.unset("spark.labelflow.broadcastBytes")
        folders = [f.removeprefix("file:") for f in settings._folders[start:]]
        assert not any(glob.glob(f"{f}/word_sets") for f in folders)  # words of sets are not shuffled and stored again
        (table,) = [f"{f}/word_numbers" for f in folders if glob.glob(f"{f}/word_numbers")]
        stored = spark.read.parquet(table).agg(F.count("*"), F.sum(F.size("ids")), F.sum(F.size("rest"))).first()
        assert stored[0] == 30 and (stored[2] == 0) == (bound is None) and (stored[1] == 0) == (bound == "1")
        want = want or got
        assert got == want and len(got) >= 39


def test_stored_texts_take_their_room_once(spark, tmp_path):
    from labelflow import plans as P

    rng = random.Random(6)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789 \n", k=4000)) for _ in range(50)]
    rows = [(i, f"u{i}", "t", t, None, '{"tags":["a"]}') for i, t in enumerate(texts)]
    records = spark.createDataFrame(rows, "id bigint, url string, title string, content string, created_at string, metadata string")
    labels = spark.createDataFrame([("a", "a b c", "a"), ("b", "d e", "b")], "label string, description string, path string")
    start = len(settings._folders)
    done = P.enrich_semantic(P.prepare(records).coalesce(1), labels, 1, dim=8)
    summary = P.store_semantic(done, str(tmp_path), "r").collect()
    assert summary[0]["total_records"] == 50 and len(summary[0]["files_created"]) == 3
    size = lambda top: sum(len(open(f, "rb").read()) for f in glob.glob(f"{top}/**/part-*", recursive=True))
    own = [f.removeprefix("file:") for f in settings._folders[start:]]
    copies = [size(f) for f in own if glob.glob(f"{f}/prepared") or glob.glob(f"{f}/enriched")] + [size(tmp_path / n) for n in ("enriched_csv", "enriched_jsonl")]
    assert len(copies) == 4 and max(copies) < 1.5 * sum(map(len, texts))  # three texts are in each
    want = {r["id"]: (r["content"], r["cleaned_content"], r["combined_text"], r["ontology_labels_k"]) for r in done.collect()}
    lines = {r["id"]: (r["content"], r["cleaned_content"], r["combined_text"], r["ontology_labels_k"]) for r in spark.read.json(f"{tmp_path}/enriched_jsonl").collect()}
    flat = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{tmp_path}/enriched_csv")
    assert lines == want and {int(r["id"]): r["combined_text"] for r in flat.collect()} == {i: w[2] for i, w in want.items()}


def test_rows_written_together_are_the_same(spark):
    df = spark.createDataFrame([(1, "a", None, ["x"]), (2, None, "", None), (None, "c", "d", [])], "_texts int, b string, `c d` string, e array<string>")
    for some in (df, df.select("_texts", "e"), df.limit(0)):
        back = settings.written_together(some, "t")
        assert back.schema.simpleString() == some.schema.simpleString() and sorted(back.collect(), key=str) == sorted(some.collect(), key=str)


def test_records_are_not_copied_for_the_cells_they_look_at(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([rng.normal(size=(150, 6)), np.zeros((2, 6)), np.ones((20, 6))])  # without structure, without direction, equal
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, vector array<float>")
    labels = df.select(F.format_string("l%03d", "id").alias("label"), F.when(F.col("id") % 2 == 0, "p").alias("path"), "vector")
    lists = lambda d: {(r["id"], tuple(r["candidate_labels"]), tuple(r["candidate_scores"])) for r in d.collect()}
    want = lists(O.attach_nearest(df, labels, 5, form="broadcast"))
    for bound in (None, "3000", "1"):  # one chunk, chunks of cells, chunks of one label
        some = labels if bound != "1" else labels.limit(8)
        start = len(settings._folders)
        if bound:
            spark.conf.set("spark.labelflow.broadcastBytes", bound)
        try:
            got = lists(O.attach_nearest(df, some, 5, form="cells"))
        finally:
            spark.conf.unset("spark.labelflow.broadcastBytes")
        assert got == (want if some is labels else lists(O.attach_nearest(df, some, 5, form="broadcast")))
        (asked,) = [f"{f}/asked".removeprefix("file:") for f in settings._folders[start:] if glob.glob(f"{f}/asked".removeprefix("file:"))]
        assert spark.read.parquet(asked).columns == ["_key", "_v"] and spark.read.parquet(asked).count() == 170
