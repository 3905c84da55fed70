import random
import re
from collections import Counter

import pytest
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import rules

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def plain_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_counts_by_brute_force(spark):
    rng = random.Random(9)
    made = ["".join(rng.choice(["a ", "b ", "c\n", "d\t", "e", "\x0b", "é日 ", "|#", "\x85", "\xa0 ", "a b c d e f ", "\n"]) for _ in range(rng.randint(0, 120))) for _ in range(150)]
    texts = made + ODD_TEXTS + ["a b c d e", "a b c d e a b c d e", "x " * 9, "x " * 10, "1 2 3 4 5 6 7 8 9 10"]
    rows = rules.quality_rules(documents(spark, texts, extra="word_chars")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        assert got == plain_counts(texts[r["doc_id"]]), texts[r["doc_id"]]


@pytest.mark.parametrize("line, passes", [
    ("A plain sentence of several ordinary words.", True), ("A title without a stop at its end", True), ("Menu item", False), ("Yes.", True),
    ("“Yes!”", True), ("", True), ("   ", True), ("home | news | sport | about | contact", False), ("a | b", False),
    ("All rights reserved.", False), ("Sign in to read the rest of this story.", False), ("He was about to sign in the presence of two of his oldest friends, and did.", True),
    ("this*** that$$$ those%%% these### them&&&", False), ("FOR!! ONE!! AND!! ALL!! NOW!!", False), ("Ça va très bien, merci à vous.", True),
    ("© 2021 Beispiel GmbH, alle Rechte vorbehalten.", False), ("Bitte lesen Sie unsere DATENSCHUTZERKLÄRUNG, bevor Sie weitergehen.", False),
    ("© 2021 Exemple, TOUS DROITS RÉSERVÉS.", False), ("Lire notre politique de confidentialité avant de continuer.", False), ("Voir les conditions d’utilisation du site.", False),
    ("Lea nuestra política de privacidad antes de continuar.", False), ("Para seguir leyendo, inicia sesión con tu cuenta.", False),
    ("Die Rechte und Pflichten stehen im dritten Teil.", True), ("La politique de la ville a changé cette année.", True), ("La política de su país ha cambiado mucho.", True), ("これは文です。", True),
])
def test_line_rules(spark, line, passes):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(rules.line_passes(F.col("line"), rules.DEFAULTS)).first()[0] is passes


def test_very_long_texts(spark):
    sentence = "Quiet rivers{} carry stones{} towards distant shores{} every single spring{}."
    text = "\n".join(sentence.format(i, i, i, i) for i in range(20_000)) + "\nAll rights reserved.\n" + "x" * 500_000
    r = rules.quality_rules(documents(spark, [text])).first()
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == plain_counts(text)
    assert r["lost_chars"] == len("Allrightsreserved.") + 500_000 and "reserved" not in r["clean_text"] and r["kept"]


def test_documents_that_lose_too_much_are_rejected(spark):
    good = "\n".join(f"Sentence{i} number{i} says{i} something{i} quite{i} new{i} here{i}." for i in range(10))
    menu = "\n".join(f"item {i}" for i in range(60))
    texts = [good, good + "\nAll rights reserved.", good + "\n" + menu, menu, *ODD_TEXTS]
    docs = repeated_rows(spark, texts).withColumn("_text", F.lit("mine")).withColumn("clean_text", F.lit("old"))
    kept = rules.keep_good(docs)
    assert kept.columns == docs.columns
    by_id = {r["doc_id"]: r for r in kept.collect()}
    assert kept.count() == 4 and set(by_id) == {0, 1}
    assert by_id[0]["text"] == good and by_id[1]["text"] == good and by_id[1]["n_chars"] == len(good) and by_id[1]["clean_text"] == "old"
    assert rules.keep_good(docs.limit(0)).count() == 0
    assert rules.quality_rules(documents(spark, [good])).filter("kept AND lost_chars = 0").count() == 1


def test_no_python_in_the_plan(spark, capsys):
    rules.keep_good(documents(spark, ["x"]).filter("doc_id >= 0")).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out.replace("ExistingRDD", ""))
