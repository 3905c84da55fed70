import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import decontaminate as D


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def bag(w):
    return Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))


def plain(text, items):
    """Items with a window as long as they are that agrees by 0.8, by brute force."""
    w, found = words(text), set()
    for i, item in enumerate(map(words, items)):
        there, size = bag(item), min(len(item), len(w))
        if 1 <= len(item) < 5 and any(w[s:s + size] == item for s in range(len(w) - len(item) + 1)):
            found.add(i)
        for s in range(len(w) - size + 1) if len(item) >= 5 and size >= 5 else ():
            here = bag(w[s:s + size])
            shared = sum((here & there).values())
            if shared >= 0.8 * (sum(here.values()) + sum(there.values()) - shared):
                found.add(i)
                break
    return found


def invented(rng, n):
    return [f"{rng.choice(['al', 'be', 'ga', 'de'])}{rng.randint(0, 60)}" for _ in range(n)]


def test_multi_index_finds_every_print_within_the_radius():
    rng = np.random.default_rng(5)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, k % 22, replace=False)) for k in range(300)]
    queries = prints ^ np.array(flips, np.uint64)
    q, e, d = D.MultiIndex(prints).within(queries)
    distance = np.bitwise_count(queries[:, None] ^ prints[None, :])
    assert set(zip(q.tolist(), e.tolist())) == set(map(tuple, np.argwhere(distance <= D.RADIUS).tolist()))
    assert (distance[q, e] == d).all()
    assert len(D.MultiIndex(np.empty(0, np.uint64)).within(queries)[0]) == 0


def test_search_by_brute_force_on_edited_passages():
    rng = random.Random(6)
    items = [" ".join(invented(rng, rng.randint(12, 60))) for _ in range(60)] + ["too short", "", None]
    texts = []
    for i in range(240):
        passage = words(items[i % 60])
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(passage))
            passage[k:k + 1] = rng.choice([["other"], [], [passage[k], "more"]])
        body = invented(rng, rng.randint(0, 120))
        k = rng.randint(0, len(body))
        texts.append(" ".join([*body[:k], *passage, *body[k:]]))
    got = [{m.item for m in found} for found in D.Items(items).search(pa.array(texts))]
    want = [plain(t, items) for t in texts]
    assert sum(map(len, want)) > 60
    assert all(g <= w for g, w in zip(got, want))
    # the radius leaves out few of the windows right at the limit
    assert sum(len(g) for g in got) >= 0.97 * sum(len(w) for w in want)


def test_windows_right_at_the_limit_are_found():
    rng = random.Random(9)
    items = [" ".join(invented(rng, rng.randint(50, 80))) for _ in range(100)]
    texts, want = [], []
    for i in range(500):
        passage, agreed = words(items[i % 100]), 1.0
        while agreed >= 0.8:
            last = list(passage)
            passage[rng.randrange(len(passage))] = "other"
            a, b = (Counter(" ".join(w[k:k + 5]) for k in range(len(w) - 4)) for w in (passage, words(items[i % 100])))
            agreed = (a & b).total() / (a | b).total()
        texts.append(" ".join(last))
        want.append(i % 100)
    got = [{m.item for m in found} for found in D.Items(items).search(pa.array(texts))]
    assert sum(w in g for w, g in zip(want, got)) >= 0.99 * len(texts)


def test_case_punctuation_and_line_ends_do_not_hide_a_passage(spark):
    passage = "Wind over the cold grey hills, and rain upon the sea until the morning."
    texts = ["Before. " + passage.upper().replace(" ", "\n") + " after", "wind over the hills", "clean " * 30, *ODD_TEXTS]
    bench = spark.createDataFrame([("b1", passage), ("b2", passage), ("b3", None), ("b4", "wind over"), (None, "x y z w v u t s")], "item_id string, text string")
    got = D.contaminated(documents(spark, texts, extra="item"), bench)
    assert got.columns == ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"]
    assert sorted(map(tuple, got.collect())) == [(0, "b1", 1, 14, 0, 1.0), (0, "b2", 1, 14, 0, 1.0), (0, "b4", 1, 2, 0, 1.0), (1, "b4", 0, 2, 0, 1.0)]


def test_items_of_one_to_four_words(spark, monkeypatch):
    rng = random.Random(11)
    items = ["four words only here", "only here", "Here!", "words only", "", None, "É", "here", "a b c d e", "c d"]
    texts = ["Four words, ONLY here", "only four words here", "here only", "é e\u0301", "a b c", "c", "a b c d e f", "words\nonly here", None, "", "four words only"]
    texts += [" ".join(rng.choices("four words only here a b c d e".split(), k=rng.randint(1, 40))) for _ in range(80)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = documents(spark, texts).repartition(3)
    want = {(i, k) for i, t in enumerate(texts) for k in plain(t, items)}
    got = D.contaminated(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    for r in got:
        if len(words(items[r["item_id"]])) < 5:
            own = words(items[r["item_id"]])
            assert words(texts[r["doc_id"]])[r["start_word"]:r["start_word"] + r["n_words"]] == own
    clean = {i for i in range(len(texts))} - {i for i, _ in want}
    assert {r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()} == clean
    monkeypatch.setattr(D, "PASS_ITEMS", 3)
    assert {r["doc_id"] for r in D.drop_contaminated(docs, bench).collect()} == clean


def test_twenty_thousand_items_in_one_pass(spark):
    rng = random.Random(12)
    items = [" ".join(f"w{rng.randrange(30_000)}" for _ in range(12)) for _ in range(20_000)]
    docs = documents(spark, [f"x y {items[i]} z" for i in range(0, 20_000, 20)] + ["clean words"] * 50)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string").repartition(4)
    found = D.contaminated(docs, bench)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(k, i) for k, i in enumerate(range(0, 20_000, 20))}
    assert D.drop_contaminated(docs, bench).count() == 50


def test_very_long_texts():
    passage = "seven small boats went out to the harbour wall at noon"
    filler = "the sea was calm " * 100_000
    items = D.Items([passage, "calm passage", "x" * 1_000_000])
    found = items.search(pa.array([filler + passage + " " + filler, "x" * 1_000_000, filler + "calm passage"]))
    assert [[m.item for m in f] for f in found] == [[0], [2], [1]]


def test_drop_keeps_all_other_rows_and_columns(spark):
    passage = "seven small boats went out to the harbour wall at noon"
    docs = repeated_rows(spark, [passage, "x " + passage + " y", "a clean text about boats", None]).withColumn("distance", F.lit("mine"))
    bench = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    kept = D.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "3", "3", "None", "None"]
    assert D.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert D.contaminated(docs, bench.limit(0)).count() == 0
    assert D.contaminated(docs.limit(0), bench).count() == 0


def test_a_benchmark_of_several_blocks_gives_the_same(spark, monkeypatch):
    rng = random.Random(7)
    items = [" ".join(invented(rng, 20)) for _ in range(30)]
    docs = documents(spark, [" ".join(invented(rng, 30)) + " " + items[i % 30] for i in range(60)])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    whole = sorted(map(tuple, D.contaminated(docs, bench).collect()))
    monkeypatch.setattr(D, "PASS_ITEMS", 7)
    monkeypatch.setattr(D, "INDEX_ITEMS", 3)
    assert sorted(map(tuple, D.contaminated(docs, bench).collect())) == whole
    assert len(whole) >= 60
    assert D.drop_contaminated(docs, bench).count() == 0


def test_the_plan_holds_one_block_of_the_benchmark(spark, monkeypatch):
    rng = random.Random(8)
    items = [" ".join(invented(rng, 20)) for _ in range(12)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    monkeypatch.setattr(D, "PASS_ITEMS", 4)
    found = D.contaminated(documents(spark, items), bench)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(i, i) for i in range(12)]
