import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import langid, quality_model
from labelflow.llm.batches import Memo

WORDS = {
    "en": "the house and water over under morning light bringing walked through other thing nothing".split(),
    "de": "das haus und wasser über unter morgen licht bringen gegangen durch andere sache nichts".split(),
    "fr": "la maison et eau sur sous matin lumière apporter marché travers autre chose rien".split(),
}


def texts_of(rng, n, langs=("en", "en", "de", "fr")):
    out = []
    for i in range(n):
        lang = langs[i % len(langs)]
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 30))) + ".", lang))
    return out


def test_languages_of_held_out_texts(spark):
    rng = random.Random(12)
    docs = spark.createDataFrame(texts_of(rng, 400), "doc_id bigint, text string, lang string")
    model = langid.fit(docs.filter("doc_id >= 100"))
    assert model.langs[0] == "en" and set(model.langs) == {"en", "de", "fr"}
    out = langid.identify(docs.filter("doc_id < 100").withColumn("score", F.lit("old")), model)
    assert out.columns == ["doc_id", "lang", "lang_pred", "score"]
    rows = out.collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) >= 0.98 and all(0 <= r["score"] <= 1 for r in rows)
    # words never seen go by their n-grams
    unseen = spark.createDataFrame([(1, "morgens gebringen lichtes"), (2, "mornings lightly housing"), (3, "maisons lumières")], "doc_id bigint, text string")
    assert [r["lang_pred"] for r in langid.identify(unseen, model).orderBy("doc_id").collect()] == ["de", "en", "fr"]


def plain_scores(model, text):
    """Word by word, as the method is written down."""
    total = np.zeros(len(model.langs))
    known = dict(zip(model.words.to_pylist(), model.word_logs))
    grams = model.place
    for w in [w for w in langid.words_of(pa.array([text])).to_pylist()[0] if w]:
        if w in known:
            total += known[w]
            continue
        marked = f"^{w}$"
        for n in range(min(langid.LONGEST, len(marked)), 0, -1):
            hits = [grams[marked[i:i + n]] for i in range(len(marked) - n + 1) if marked[i:i + n] in grams]
            if hits:
                total += model.gram_logs[hits].mean(axis=0)
                break
    return total


def test_scores_are_those_of_the_method(spark):
    rng = random.Random(13)
    docs = spark.createDataFrame(texts_of(rng, 60), "doc_id bigint, text string, lang string")
    model = langid.fit(docs)
    texts = [r["text"] + " unbekannt housings 日本 ça-et-là" for r in docs.limit(20).collect()] + [t or "" for t in ODD_TEXTS]
    langs, sure = model.predict(pa.array(texts), Memo(model.unseen))
    for text, lang, p in zip(texts, langs, sure):
        if not any(c.isalpha() for c in text):
            assert (lang, p) == ("und", 0.0)
            continue
        scores = plain_scores(model, text)
        odds = np.exp(scores - scores.max())
        assert lang == model.langs[int(scores.argmax())] and np.isclose(p, 1 / odds.sum())


def test_language_model_without_rows_and_with_odd_ones(spark):
    odd = repeated_rows(spark, ODD_TEXTS)
    nothing = langid.fit(odd.limit(0))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(odd, nothing).collect()} == {("und", 0.0)}
    assert langid.fit(odd.withColumn("lang", F.lit(None).cast("string"))).langs == []
    some = langid.fit(odd)
    out = langid.identify(odd, some)
    assert out.count() == odd.count() and langid.identify(odd.limit(0), some).count() == 0
    assert out.filter("lang_pred = 'und'").filter("text IS NOT NULL" if "text" in out.columns else "score <> 0").count() == 0


def test_samples_are_bounded_and_repeatable(spark):
    df = spark.range(20_000).withColumnRenamed("id", "doc_id")
    some = langid.sampled(df, 1000, "doc_id")
    assert 850 < some.count() < 1150
    assert sorted(some.collect()) == sorted(langid.sampled(df.repartition(7), 1000, "doc_id").collect())
    assert langid.sampled(df, 20_000, "doc_id").count() == 20_000


def quality_tables(spark, n=600):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(WORDS["en"]) + str(rng.randint(0, 99)) for _ in range(rng.randint(20, 200))]
        bad = i % 4 == 0
        text = " ".join(w + rng.choice(["***", "$$$", "%%%"]) for w in words) if bad else " ".join(words).capitalize() + "."
        rows.append((i, text))
        labels.append((i, 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_quality_of_held_out_documents(spark):
    docs, labels = quality_tables(spark)
    out = quality_model.fit_and_score(docs, labels, lambda c: langid.fold(c, 5) == 0, lambda c: langid.fold(c, 5) == 4)
    held = out.filter(langid.fold(F.col("doc_id"), 5) == 0).join(labels, "doc_id").collect()
    assert len(held) > 80 and np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in held]) >= 0.97
    # labels of held-out documents are never read
    flipped = labels.withColumn("quality", F.when(langid.fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality_model.fit_and_score(docs, flipped, lambda c: langid.fold(c, 5) == 0, lambda c: langid.fold(c, 5) == 4)
    assert np.allclose([r["score"] for r in out.orderBy("doc_id").collect()], [r["score"] for r in again.orderBy("doc_id").collect()])


def test_summed_equations_give_the_ridge_solution(spark):
    docs, labels = quality_tables(spark, 200)
    rows = quality_model.with_statistics(docs).join(labels, "doc_id").select("stats", F.col("quality").cast("double").alias("label"), F.lit(False).alias("calibrate"))
    model = quality_model.fit(rows.repartition(7))
    data = rows.collect()
    stats, y = np.array([r["stats"] for r in data]), np.array([r["label"] for r in data])
    assert np.allclose(model.centre, stats.mean(axis=0))
    x = model.features(stats)
    penalty = quality_model.RIDGE * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-9
    assert np.allclose(model.weights, np.linalg.solve(x.T @ x + penalty, x.T @ y), atol=1e-6)
    # the features approximate the kernel
    z = (stats[:40] - model.centre) / model.spread
    kernel = np.exp(-((z[:, None] - z[None]) ** 2).sum(axis=2) / 2 / quality_model.LENGTH**2)
    assert np.abs(x[:40, :-1] @ x[:40, :-1].T - kernel).mean() < 0.08


def test_isotonic_pools_like_the_definition():
    rng = np.random.default_rng(15)
    for _ in range(50):
        n = int(rng.integers(1, 9))
        x, total = np.sort(rng.random(n)), rng.integers(1, 5, n)
        ones = np.array([rng.integers(0, t + 1) for t in total])
        at, share = quality_model.isotonic(x, total, ones)
        assert (np.diff(share) >= 0).all() and (np.diff(at) >= 0).all()
        # the least squares rising fit is the max over starts of the min over ends of the mean
        want = [max(min(ones[a:b + 1].sum() / total[a:b + 1].sum() for b in range(k, n)) for a in range(k + 1)) for k in range(n)]
        assert np.allclose(np.interp(x, at, share), want)


def test_quality_without_labels_and_with_odd_rows(spark):
    odd = repeated_rows(spark, ODD_TEXTS)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    never = lambda c: F.lit(False)
    assert {round(r["score"], 2) for r in quality_model.fit_and_score(odd, none, never, never).collect()} == {0.5}
    labels = spark.createDataFrame([(0, 1), (0, 1), (1, None), (None, 0), (999, 1), (5, 1)], "doc_id bigint, quality int")
    out = quality_model.fit_and_score(odd, labels, never, never)
    assert out.count() == odd.count() and out.filter("score BETWEEN 0 AND 1").count() == odd.count()
    assert quality_model.fit_and_score(odd.limit(0), labels, never, never).count() == 0


def test_statistics_of_long_texts_are_made_in_pieces(monkeypatch):
    text = ("one two two three. " * 40 + "\n") * 30
    whole = quality_model.statistics(text.encode())
    monkeypatch.setattr("labelflow.llm.batches.chunks.__defaults__", (100,))
    assert np.allclose(quality_model.statistics(text.encode()), whole)
    assert quality_model.statistics(b"") == [0.0] * quality_model.STATISTICS


def spelled(rng, lang, n=12):
    """Words over letters that a language has for itself mostly."""
    own = "abcdefghijklmnopqrstuvwxyz"
    letters = [own[(lang * 7 + k * (1 + lang % 5)) % 26] for k in range(6)]
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) + f"{own[lang % 26]}{own[lang // 26]}" for _ in range(n))


def test_three_hundred_languages(spark):
    rng = random.Random(3)
    rows = [(i, spelled(rng, i % 300), f"l{i % 300}") for i in range(3000)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert len(model.langs) == 300
    asked = [(i, spelled(rng, i % 300)) for i in range(600)]
    out = langid.identify(spark.createDataFrame(asked, "doc_id bigint, text string"), model).collect()
    assert sum(r["lang_pred"] == f"l{r['doc_id'] % 300}" for r in out) > 0.95 * 600


def test_a_rare_language_keeps_its_rows_and_words(spark):
    """One row in 2,500 of a table, of which a sample of 400 rows is taken."""
    rng = random.Random(4)
    rows = [(i, spelled(rng, 0 if i % 2500 else 9), "hot" if i % 2500 else "rare") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    some = langid.sampled_by(df, 400, "lang", "doc_id").groupBy("lang").count().collect()
    sizes = {r["lang"]: r["count"] for r in some}
    assert sizes["rare"] == 8 and 120 < sizes["hot"] < 300
    model = langid.fit(df, rows=400)
    asked = spark.createDataFrame([(i, spelled(rng, 9)) for i in range(20)], "doc_id bigint, text string")
    assert {r["lang_pred"] for r in langid.identify(asked, model).collect()} == {"rare"}


def test_counts_of_the_language_model(spark):
    rows = [(1, "The the cat", "en"), (2, "die Katze the", "de"), (3, "die", "de"), (4, None, "de"), (5, "x", None)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    counts = {"en": {"the": 2, "cat": 1}, "de": {"die": 2, "katze": 1, "the": 1}}
    assert model.langs == ["de", "en"]
    words = ["cat", "die", "katze", "the"]
    assert sorted(model.words.to_pylist()) == words
    for i, lang in enumerate(model.langs):
        total = sum(counts[lang].values())
        for w in words:
            want = np.log(counts[lang].get(w, 0) + 0.5) - np.log(total + 0.5 * (len(words) + 1))
            assert model.word_logs[model.words.to_pylist().index(w), i] == pytest.approx(want)
