import random
import sys
from pathlib import Path

import public_tokenizers
from helpers import ODD_TEXTS, documents, repeated_rows

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402

from labelflow.llm import decontaminate, pieces, pii, rules, simhash  # noqa: E402


def sentence(rng, n):
    return (" ".join(f"{rng.choice(['al', 'be', 'ga'])}{rng.choice('abcdefghij')}{rng.choice('klmnopqr')}{rng.randint(0, 9)}" for _ in range(n)) + ".").capitalize()


def write(spark, folder, docs, items):
    docs.write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(folder / "benchmark.parquet"))


def test_every_stage_takes_effect(spark, tmp_path):
    rng = random.Random(16)
    clean = ["\n".join(sentence(rng, 12) for _ in range(8)) for _ in range(12)]
    item = sentence(rng, 20)
    texts = clean + [clean[0], clean[1].upper()] + [clean[2] + "\n" + item] + ["menu | home | a | b | c | d | e | f | g | h"] + ["Mail me: bob@mail.example.com please.\n" + sentence(rng, 30)] + ODD_TEXTS
    write(spark, tmp_path, documents(spark, texts, extra="fp"), [(0, item), (1, None)])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "simhash near-dedup", "benchmark decontamination", "personal data", "piece encoding"]
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(out) == [*range(12), 16]
    assert out[3]["decoded"].strip() == clean[3] and len(out[3]["ids"]) == 4 * out[3]["n_tokens"]
    assert "<EMAIL>" in out[16]["decoded"] and "bob" not in out[16]["decoded"]


def test_pipeline_by_brute_force(spark, tmp_path):
    """Each stage on its own input against plain Python on the whole table."""
    rng = random.Random(17)
    items = [sentence(rng, rng.randint(12, 30)) for _ in range(6)]
    texts = []
    for i in range(80):
        t = "\n".join(sentence(rng, rng.randint(4, 14)) for _ in range(rng.randint(1, 9)))
        texts += [t + rng.choice(["", "\n" + rng.choice(items), " Call +1 (555) 123-4567 now.", "\nAll rights reserved."])]
        texts += [t] if rng.random() < 0.3 else []
    write(spark, tmp_path, documents(spark, texts), list(enumerate(items)))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stage = dict(corpus_pipeline.STAGES)
    good = {r["doc_id"]: r["text"] for r in stage["quality rules"](spark, docs, str(tmp_path)).collect()}
    judged = {r["doc_id"]: r for r in rules.quality_rules(docs).collect()}
    assert good == {d: r["clean_text"] for d, r in judged.items() if r["kept"]}

    prints = {d: simhash.fingerprint(t.encode()) for d, t in good.items()}
    group = {d: d for d in good}
    while (lower := {d: min(group[e] for e in good if (prints[d] ^ prints[e]).bit_count() <= 3) for d in good}) != group:
        group = lower
    firsts = {d for d in good if group[d] == d}
    rows = documents(spark, []).unionByName(docs.limit(0)).unionByName(spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in good.items()], docs.schema))
    assert {r["doc_id"] for r in stage["simhash near-dedup"](spark, rows, str(tmp_path)).collect()} == firsts

    search = decontaminate.Items(items)
    import pyarrow as pa

    leak = {d for d in firsts if search.search(pa.array([good[d]]))[0]}
    assert leak and all(any(i in good[d] for i in items) == (d in leak) for d in firsts)
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    want = {d: model.encode([pii.masked(good[d])])[0].tobytes() for d in firsts - leak}
    assert {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == want


def test_odd_rows_and_empty_tables(spark, tmp_path):
    (tmp_path / "a").mkdir()
    write(spark, tmp_path / "a", repeated_rows(spark, ODD_TEXTS), [])
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() == 0
    (tmp_path / "b").mkdir()
    write(spark, tmp_path / "b", repeated_rows(spark, ODD_TEXTS).limit(0), [(1, "x")])
    assert corpus_pipeline.run(spark, str(tmp_path / "b")).count() == 0
