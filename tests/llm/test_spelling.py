"""Spelling variants against a plain search over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import spelling
from labelflow.llm.spelling import bounds, matched, spelling_variants


def neighbours(word, alphabet):
    """All strings one edit away."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in alphabet}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in alphabet}
    return out - {word}


def expected(rows, garble=None, min_length=7, min_count=2, ratio=10):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if garble:
                h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
                if h % garble == 0:
                    word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= min_length:
                counts[word] += 1
    words = {w: n for w, n in counts.items() if n >= min_count}
    alphabet = set("".join(words))
    near = {w: neighbours(w, alphabet) & words.keys() for w in words}
    forms = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), None if forms[w] is None else words[forms[w]])
    return out


def check(df, garble=None, **options):
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = spelling_variants(df, garble=garble, **options)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = {r["word"]: tuple(r)[1:] for r in out.collect()}
    want = expected(rows, garble)
    assert got == want
    return want


def corpus(seed, n=60, words=25):
    """Texts of words with very different counts, and variants of theirs of one or two edits."""
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeéÀ", k=rng.randint(6, 12))) for _ in range(words)]
    pool = []
    for k, w in enumerate(base):
        pool += [w] * (1 + 6 ** (k % 4))
        for _ in range(4):
            v = list(w)
            for _ in range(rng.randint(1, 2)):
                at = rng.randrange(len(v))
                v[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "e", "é", "À"])
            pool += ["".join(v)] * rng.choice([1, 2, 3, 20])
    return [" ".join(x.upper() if rng.random() < 0.1 else x for x in rng.choices(pool, k=rng.randint(5, 120))) + rng.choice(["", ".", " 12", "-x"]) for _ in range(n)]


@pytest.mark.parametrize("s", [2, 5, 7, 8, 13])
def test_intervals_hold_every_pair_once(s):
    rng = random.Random(s)
    words = sorted({"".join(rng.choices("ab", k=s + rng.randint(0, 1))) for _ in range(60)})
    n = np.array([rng.randint(1, 5) for _ in words])
    for parts in ([0, 1, 2], list(range(3, 3 + s))):
        total = sum(matched(words, n, s, bounds(s, p, 3))[0] for p in parts)
        near = {w: neighbours(w, "ab") & set(words) for w in words}
        assert total.tolist() == [sum(min(len(w), len(x)) == s for x in near[w]) for w in words]


def test_against_all_pairs(spark):
    chain = ["daughter " * 3000, "dauhter " * 200, "dauhtr,dauhtr " * 5, "douhtr' " * 30, "dauter " * 15, "daute " * 2]
    want = check(documents(spark, corpus(1) + ODD_TEXTS + chain + ["daughters " * 250, "daughtersx " * 20, "doughtersx " * 2]).repartition(4), garble=31)
    assert any(f for f, *_ in want.values()) and any(f and r != f for f, r, *_ in want.values())
    check(documents(spark, corpus(2)), garble=2)


def test_hot_keys_and_small_shards(spark):
    check(documents(spark, corpus(3)), hot_key=3, shard_rows=20)
    check(documents(spark, corpus(4)), hot_key=1, shard_rows=5, parts=2)


def test_bitsets_that_are_not_kept(spark, monkeypatch):
    rng = random.Random(8)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(7, 8))) for _ in range(300)})
    n = np.array([rng.randint(1, 50) for _ in words])
    whole = matched(words, n, 7, (0, 6))
    monkeypatch.setattr(spelling, "PLANES", 0)
    monkeypatch.setattr(spelling, "BLOCK", 7)
    monkeypatch.setattr(spelling, "PAIRS", 16)
    parts = matched(words, n, 7, (0, 6))
    assert all((a == b).all() for a, b in zip(whole, parts))


def test_repeated_rows_null_ids_and_ties(spark):
    check(repeated_rows(spark, ["maintain maintains", "maintain contain's maintainÉ", None, "mantain " * 3]), garble=3)
    check(documents(spark, ["aaaaaaaa " * 40 + "aaaaaaab " * 40 + "aaaaaaac aaaaaaac"]))


def test_very_long_texts_and_words(spark):
    long = "z" * 2000
    check(documents(spark, [f"{long} {long} {long}a {long}a " + "wonderful " * 100_000 + "wonderfull " * 2, long + " " + "ß" * 1500, "ß" * 1500]))


def test_empty_table_and_clashing_columns(spark):
    assert spelling_variants(documents(spark, [])).collect() == []
    check(documents(spark, ["wonderful wonderful wonderfull wonderfull"]).withColumns({c: F.lit("x") for c in ("word", "n", "key", "doc", "shard")}))
