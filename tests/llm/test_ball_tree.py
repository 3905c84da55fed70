"""Ranked search against plain scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import ball_tree
from labelflow.llm.ball_tree import BallTree, Rows, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, k=50):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in set(plain_terms(text)) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(scores[:k])]
    return sorted(out, key=str)


def check(spark, df, items, k=50, **options):
    table = spark.createDataFrame(items, "item_id bigint, text string")
    out = ranked_search(df, table, k=k, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == expected([(r["doc_id"], r["text"]) for r in df.collect()], items, k)
    return got


def corpus(seed, n):
    rng = random.Random(seed)
    rare = [f"rare{i}" for i in range(200)]
    common = ["the", "of", "été", "Straße", "x", "1984"]
    return [" ".join(rng.choices(common, k=rng.randint(0, 30)) + rng.choices(rare, k=rng.randint(0, 12))) + rng.choice(["", "!", "\0", " THE-OF"]) for _ in range(n)]


def test_bounds_hold_and_search_is_exact():
    rng = np.random.default_rng(3)
    width = 60
    block = rng.integers(0, 8, width)
    dense = rng.integers(1, 10 ** 10, (500, width)) * (rng.random((500, width)) < 0.1)
    dense[:, 0] = 7
    dense[100:200] = dense[100]
    rows, cols = np.nonzero(dense)
    tree = BallTree(Rows(np.searchsorted(rows, np.arange(501)), cols, dense[rows, cols]), width, block, 8, leaf=10)
    asked = [np.sort(rng.choice(width, rng.integers(1, 9), replace=False)) for _ in range(40)]
    bounds = tree.bounds(asked, block)
    ids, no_id = rng.permutation(500), np.zeros(500, bool)
    visited = 0
    for j, t in enumerate(asked):
        scores = dense[:, t].sum(axis=1)
        for node, (a, b) in enumerate(zip(tree.first, tree.last)):
            assert bounds[node, j] >= scores[tree.order[a:b]].max()
        visited += sum(bounds[i, j] >= np.sort(scores)[-5] for i, c in enumerate(tree.child) if not c)
        wanted = np.isin(np.arange(width), t).astype(np.int64)
        found, score = tree.best(wanted, bounds[:, j].tolist(), 5, 1, ids, no_id)
        order = [i for i in np.lexsort((ids, -scores)) if scores[i] >= 1][:5]
        assert found.tolist() == order and score.tolist() == scores[order].tolist()
    assert visited < 40 * sum(not c for c in tree.child)  # some leaves are skipped


def test_against_all_scores(spark):
    rng = random.Random(1)
    texts = corpus(1, 400) + ODD_TEXTS
    items = [(i, " ".join(rng.choices(texts[:400], k=1)[0].split()[:20])) for i in range(30)] + [(40, None), (41, "..."), (42, "nowhere found"), (43, "the the THE")]
    items += [(44, "rare1 rare2"), (44, "rare1 rare2")]
    check(spark, documents(spark, texts).repartition(5), items, k=10, shard_docs=40)
    check(spark, documents(spark, texts).repartition(3), items, sample=30, item_bytes=300)
    check(spark, documents(spark, texts).repartition(3), items, k=7, sample=50, shard_docs=70)


def test_items_by_blocks_of_columns(spark, monkeypatch):
    monkeypatch.setattr(ball_tree, "ITEMS_AT_ONCE", 4)
    texts = corpus(2, 150)
    check(spark, documents(spark, texts), [(i, t) for i, t in enumerate(texts[:21])], k=3)


def test_ties_copies_and_null_ids(spark):
    texts = ["one same text"] * 200 + ["one other text"] * 5 + [None, ""]
    got = check(spark, documents(spark, texts).repartition(6), [(1, "same"), (2, "one text")], k=20, shard_docs=16, sample=20)
    assert [d for i, _, d, _ in sorted(got) if i == 1] == list(range(20))
    check(spark, repeated_rows(spark, ["no id", "at all", "here", ""]), [(1, "no id here")], k=4)


def test_very_long_texts(spark):
    texts = ["alpha beta " * 150_000, "alpha " + "x" * 2_000_000, "beta", "gamma " * 10]
    check(spark, documents(spark, texts), [(1, "alpha gamma"), (2, "beta " * 100_000), (3, "x" * 2_000_000)])


def test_empty_tables_and_clashing_columns(spark):
    none = documents(spark, [])
    items = [(1, "a b")]
    check(spark, none, items)
    check(spark, documents(spark, ["a"]), [])
    odd = documents(spark, ["a b", "b c"]).withColumns({c: F.lit("x") for c in ("item_id", "score", "rank", "n", "terms", "doc")})
    check(spark, odd, items)
