"""Exact duplicates against a dictionary of whole texts, with collisions, huge texts and odd rows."""

import random

import pytest
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm.exact_dedup import STEP, Polynomial, drop_exact_duplicates, exact_duplicates


def lowered(text):
    return (text or "").encode().lower()


def expected(rows):
    """Per (id, text): keep_id and group size."""
    groups = {}
    for i, t in rows:
        groups.setdefault(lowered(t), []).append(i)
    return {k: (max((i for i in ids if i is not None), default=None), len(ids)) for k, ids in groups.items()}


def check(spark, df, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = exact_duplicates(df.withColumn("copy", F.col("text")), **options).collect()
    want = expected(rows)
    assert len(out) == len(rows)
    for r in out:
        assert (r["keep_id"], r["group_size"]) == want[lowered(r["copy"])]
        assert r["n_bytes"] == len(lowered(r["copy"]))
    kept = [(r["doc_id"], lowered(r["copy"])) for r in out if r["kept"]]
    assert sorted(kept, key=str) == sorted(((k, t) for t, (k, _) in want.items()), key=str)


def test_runs_join_to_the_whole():
    rng = random.Random(4)
    poly = Polynomial()
    data = rng.randbytes(3 * STEP + 17)
    plain = sum(b * pow(poly.base, i, poly.modulus) for i, b in enumerate(data[:2000])) % poly.modulus
    assert poly.of(data[:2000]) == plain
    for _ in range(20):
        cuts = sorted(rng.randrange(len(data) + 1) for _ in range(rng.randrange(6)))
        runs = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert poly.joined((poly.of(r), len(r)) for r in runs) == (poly.of(data), len(data))
    assert poly.key(poly.of(b"a"), 1) != poly.key(poly.of(b"a\0"), 2)


def test_copies_case_and_near_misses(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("alpha Beta GAMMA Été straße".split(), k=rng.randint(1, 6))) for _ in range(300)]
    texts += [t.upper() for t in texts[:30]] + [t + " " for t in texts[:30]] + ["É", "é", "A\0", "a\0", "a"] + ODD_TEXTS
    check(spark, documents(spark, texts).repartition(5))


def test_repeated_rows_and_null_ids(spark):
    check(spark, repeated_rows(spark, ["One", "one", "two", None, "", "x" * 500]))


def test_hot_group(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "The Same text").otherwise(F.concat(F.lit("t"), (F.col("id") / 2).cast("int").cast("string"))).alias("text"))
    check(spark, df)


@pytest.mark.parametrize("modulus", [7])
def test_collisions_are_compared(spark, modulus):
    texts = [f"text {i % 9}" for i in range(60)] + ["aaaa" * 10, "aaaa" * 10 + "b", "", None, "b" * 40] + ["b" * 80]
    check(spark, documents(spark, texts), modulus=modulus, chunk=8)


def test_huge_texts_in_pieces(spark):
    rng = random.Random(6)
    body = "".join(rng.choices("abcdefg é", k=4000))
    texts = [body, body.upper().replace("É", "é"), body + "x", "x" + body, body[:-1], "short", "short", None]
    check(spark, documents(spark, texts), huge=1000, piece=300, chunk=128)
    check(spark, documents(spark, texts), huge=1000, piece=300, chunk=128, modulus=3)


def test_very_long_texts(spark):
    text = "Lorem é\n" * 300_000
    check(spark, documents(spark, [text, text.lower(), text + "!", "w" * 2_000_000, "W" * 2_000_000]))


def test_empty_table_and_clashing_columns(spark):
    empty = documents(spark, [])
    assert exact_duplicates(empty).collect() == [] and drop_exact_duplicates(empty).collect() == []
    odd = documents(spark, ["a", "A", "b"]).withColumns({c: F.lit("mine") for c in ("fp", "_row", "_id", "norm", "kept", "n", "_doc", "at", "part")})
    out = exact_duplicates(odd).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"], r["fp"], r["_row"]) for r in out} == {(0, 1, False, "mine", "mine"), (1, 1, True, "mine", "mine"), (2, 2, True, "mine", "mine")}
    assert sorted(r["doc_id"] for r in drop_exact_duplicates(odd).collect()) == [1, 2]
    assert drop_exact_duplicates(odd).columns == odd.columns
