import random

import numpy as np
import xxhash
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import components, simhash
from labelflow.operators import skew


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """Smallest index that each print reaches over links within the radius, by brute force."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(len(prints)):
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near_prints(rng, centres, each, flips):
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        for _ in range(each):
            x = c
            for b in rng.sample(range(64), rng.randint(0, flips)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


def test_fingerprint_is_that_of_the_rule():
    rng = random.Random(1)
    texts = [t or "" for t in ODD_TEXTS] + [" ".join(rng.choice("ab cd EF gh\tij é".split(" ")) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_fingerprint_of_a_very_long_text_is_made_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(60_000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr("labelflow.llm.batches.CHUNK", 1000)
    monkeypatch.setattr("labelflow.llm.batches.chunks.__defaults__", (1000,))
    assert simhash.fingerprint(text.encode()) == whole


def test_links_connect_what_brute_force_connects():
    rng = random.Random(2)
    for each, flips in ((40, 3), (12, 6), (1, 0)):
        prints = near_prints(rng, 20, each, flips)
        points = np.array(prints, np.uint64)
        label = simhash._labels(len(points), *simhash.links(points, points, 3))
        assert label.tolist() == groups(prints)


def test_the_links_of_a_tight_clump_are_thinned_to_a_forest(monkeypatch):
    monkeypatch.setattr(simhash, "HELD_LINKS", 1000)
    centre = 0x0F0F
    clump = np.array(sorted({centre ^ 1 << a ^ 1 << b for a in range(64) for b in range(64)} | {centre}), np.uint64)
    left, _ = simhash.links(clump, clump, 4)
    assert len(left) < 10 * len(clump)  # of 4 million pairs
    assert (simhash._labels(len(clump), *simhash.links(clump, clump, 4)) == 0).all()


def test_every_partner_in_another_shard_is_visited():
    rng = random.Random(3)
    points = np.array(near_prints(rng, 200, 6, 3), np.uint64)
    tree = simhash.Shards(points[::3], 6, 3)
    home = tree.home(points)
    at, shard = tree.visits(points, home)
    seen = set(zip(at.tolist(), shard.tolist()))
    close = np.argwhere(np.bitwise_count(points[:, None] ^ points[None, :]) <= 3)
    assert len(set(home.tolist())) > 20
    assert all(home[i] >= home[j] or (i, home[j]) in seen for i, j in close.tolist())


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 40)] + [(50, 51), (51, 50), (50, 51), (60, 60)]
    got = components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    want = [(i, 100) for i in range(101, 141)] + [(i, 7) for i in range(8, 40)] + [(51, 50)]
    assert sorted((r["u"], r["v"]) for r in got) == sorted(want)
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_join_unique_keeps_hot_and_cold_rows(spark):
    rows = spark.range(5000).select((F.col("id") % 3 * (F.col("id") % 7)).alias("k"), F.col("id").alias("x"))
    table = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"))
    got = skew.join_unique(rows, table, "k", "n", 5000)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(table.drop("n"), "k").collect()))


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 400))) for _ in range(40)]
    texts = base + [t + " tail" for t in base] + base[:5] + ODD_TEXTS
    docs = documents(spark, texts, extra="fp")
    want = groups([plain_fingerprint(t) for t in texts])
    for size in (8, 32_768):
        got = {r["doc_id"]: r for r in simhash.near_duplicates(docs, shard_points=size).collect()}
        assert [got[i]["first"]["id"] for i in range(len(texts))] == want
        assert [got[i]["fp"] & (1 << 64) - 1 for i in range(len(texts))] == [plain_fingerprint(t) for t in texts]


def test_keep_first_keeps_one_row_of_each_group(spark):
    docs = repeated_rows(spark, ["alpha beta gamma delta", "Alpha BETA gamma delta", "another text of its own", "", None]).withColumn("first", F.lit(1))
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in kept.collect()) == [
        (False, 0, "alpha beta gamma delta"), (False, 2, "another text of its own"), (False, 3, ""), (True, None, "no id at all here")]
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_a_hot_group_of_copies_is_one_point(spark):
    docs = documents(spark, ["one hot text that stands in half of all rows"] * 3000 + [f"text number {i} of {i * 7} words" for i in range(300)])
    rows = simhash.near_duplicates(docs)
    assert rows.count() == 3300
    assert rows.filter("doc_id < 3000 AND first.id = 0").count() == 3000
    assert simhash.keep_first(docs).filter("doc_id < 3000").count() == 1


def test_rows_without_near_copies_are_not_shuffled(spark):
    docs = spark.range(0, 400, 1, 7).select(
        F.when(F.col("id") < 390, F.col("id")).otherwise(F.col("id") % 2).alias("doc_id"),
        F.when(F.col("id") < 380, F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256), F.lit(" of "), F.md5(F.col("id").cast("string"))))
        .otherwise(F.lit("one text that comes again")).alias("text"), F.lit(1).alias("_held"), F.lit(2).alias("_bucket"), F.lit(3).alias("stays"))
    docs = simhash.written(docs.repartitionByRange(7, "doc_id"), "docs")
    where = {r["doc_id"]: r["part"] for r in docs.filter("text LIKE 'text %'").withColumn("part", F.spark_partition_id()).collect()}
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the little that is shuffled goes to one part
    try:
        kept = simhash.keep_first(docs)
        rows = kept.withColumn("part", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert kept.columns == docs.columns
    own = {r["doc_id"]: r["text"] for r in rows if r["text"].startswith("text ")}
    assert sorted(own) == list(range(380)) and len(set(own.values())) == 380
    assert [r["doc_id"] for r in rows if not r["text"].startswith("text ")] == [0]
    at = {}
    for r in rows:
        if r["text"].startswith("text "):
            at.setdefault(r["part"], set()).add(where[r["doc_id"]])
    # a part of the result holds whole parts of the input: but for rows that share a bit with a copy none was dealt anew
    assert sum(len(parts) > 1 for parts in at.values()) <= 1


def test_parts_are_told_by_the_bitmap(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    keys = rows.filter("k % 7 = 0")
    may, no = simhash._parts(rows, "k", keys)
    may, no = {int(r["k"]) for r in may.collect()}, {int(r["k"]) for r in no.collect()}
    assert may | no == set(range(5000)) and not may & no
    assert may >= set(range(0, 5000, 7)) and len(no) > 3500
    may, no = simhash._parts(rows, "k", keys.limit(0))
    assert may.count() == 0 and no.count() == 5000
