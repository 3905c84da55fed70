import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import ODD_TEXTS, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm import token_store as S

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 8, 9, 255, 256, 257, 70_000])
def test_elias_fano_gives_every_number_back(n):
    for top in (0, 1, n, 3 * n + 1, 10**6, 2**50):
        values = np.sort(np.random.default_rng(n).integers(0, top + 1, n, dtype=np.uint64))
        kept = S.EliasFano.from_bytes(S.EliasFano.of(values).to_bytes())
        for first, last in ((0, n), (n // 3, n // 2), (n - 1, n), (n // 2, n // 2)):
            assert (kept.run(max(first, 0), last) == values[max(first, 0):last].astype(np.int64)).all()
        for k in range(n) if n < 1000 else random.Random(n).sample(range(n), 300):
            assert kept.select(k) == values[k]


def test_boundaries_take_little_space():
    ends = np.cumsum(np.random.default_rng(0).integers(50, 2000, 100_000))
    bits = 8 * len(S.EliasFano.of(ends).to_bytes()) / 100_000
    assert bits < 2 + np.log2(ends[-1] / 100_000) + 0.5  # a table of offsets takes 64
    with pytest.raises(IndexError):
        S.EliasFano.of(ends).select(100_000)


def encoded(coder, texts):
    ids, count = coder.encode(pa.array(texts, pa.string()))
    return [i.tobytes() for i in np.split(ids, np.cumsum(count)[:-1])]


def test_words_are_encoded_as_in_the_whole_text():
    coder = S.Encoder(PATH)
    assert coder.by_part and coder.width == 2
    rng = random.Random(11)
    odd = ["it's We'll DON'T.", "ÉÀ é́  x.", "<|startoftext|>a <|endoftext|>. <|ENDOFTEXT|>", "Σας ΟΔΟΣ. ΣΑΣ", "\x1cab\x1f", "a b", "日本 語😀.", "''s", "İstanbul, ß.,.", "A.B. c.,d 4.5 ².", "one%%% two!! (three) four' five'' six's. seven'. |eight| nine<|endoftext|> ten<|endoftext|>.", "a's b're' C'LL."]
    texts = odd + [t or "" for t in ODD_TEXTS] + ["".join(rng.choice("aBé '.,\n\t1<|>s漢%!ß") for _ in range(rng.randint(0, 50))) for _ in range(800)]
    whole = [np.array(coder.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encoded(coder, texts) == whole
    coder.word.limit = coder.part.limit = 2
    coder.word.clear()
    assert encoded(coder, texts) == whole


def test_a_tokenizer_that_keeps_blanks_encodes_whole_texts():
    coder = S.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not coder.by_word
    texts = ["a  b\nc", " x", ""]
    assert encoded(coder, texts) == [np.array(coder.library.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]


def by_library(docs):
    coder, out, start = S.Encoder(PATH), [], 0
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = coder.library.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_round_trip(spark, tmp_path):
    texts = [f"Document {i} says something." * (i % 5) for i in range(500)] + ODD_TEXTS
    docs = spark.createDataFrame([(i * 3 - 200, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3).withColumn("doc", F.lit("mine"))
    folder = str(tmp_path / "ids")
    manifest = S.write_ids(docs, PATH, folder)
    got = S.read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()
    assert sorted(map(tuple, got)) == by_library([(r["doc_id"], r["text"]) for r in docs.collect()])
    # random access by select
    first = manifest.orderBy("part").first()
    file = S.IdFile(first["path"])
    assert file.doc_id(0) == -200 and file.n_docs == first["n_docs"]
    k = file.n_docs - 1
    begin, end = file.bounds(k)
    assert zlib.crc32(file.ids(begin, end).astype("<u4").tobytes()) == {r[0]: r[3] for r in got}[file.doc_id(k)]
    file.close()
    # a file that no manifest names is not read
    (tmp_path / "ids" / "part-000000-lost.ids").write_bytes(b"partial")
    assert S.read_ids(manifest).count() == len(texts)


def test_repeated_and_null_ids_and_empty_tables(spark, tmp_path):
    docs = repeated_rows(spark, ["same text", "other", None]).select("doc_id", "text")
    got = S.read_ids(S.write_ids(docs, PATH, "file://" + str(tmp_path / "a"))).collect()
    assert len(got) == docs.count()
    ordered = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == [None, None, 0, 0, 1, 1, 2, 2]
    assert [r["start"] for r in ordered] == [0] + np.cumsum([r["n_tokens"] for r in ordered]).tolist()[:-1]
    assert S.read_ids(S.write_ids(docs.limit(0), PATH, str(tmp_path / "b"))).count() == 0


def test_files_are_read_in_runs_of_documents(spark, tmp_path, monkeypatch):
    """Nulls first, the widest ids there are, and texts whose ids fill more than a run."""
    ids = [None, None, -(1 << 63), -5, 0, 1, 2, 3, (1 << 63) - 1]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id bigint, text string").coalesce(1)
    manifest = S.write_ids(docs, PATH, str(tmp_path / "ids"))
    want = by_library([(i, f"text {i}") for i in ids])
    assert [r[0] for r in S.read_ids(manifest).orderBy("start").collect()] == ids
    for r in manifest.collect():
        file = S.IdFile(r["path"])
        for first in range(file.n_docs):
            for last in range(first, file.n_docs + 1):
                docs, bounds = file.documents(first, last)
                assert docs.to_pylist() == [file.doc_id(k) for k in range(first, last)]
                assert bounds.tolist()[1:] == [file.bounds(k)[1] for k in range(first, last)] and bounds[0] == (file.bounds(first - 1)[1] if first else 0)
        file.close()
    assert len(want) == len(ids)


def test_long_words_are_encoded_and_not_remembered():
    """Words of a megabyte, of which there may be many (base64, code in one line)."""
    coder = S.Encoder(PATH)
    words = ["".join(random.Random(k).choice("abcdefghijklmnop+/=") for _ in range(1 << 20)) for k in range(3)]
    many = [f"{k:x}" * 90 for k in range(1 << 20, (1 << 20) + 2000)]
    coder.word.room = 100_000
    assert encoded(coder, words) == coder._many(words)
    assert encoded(coder, [" ".join(many)]) == [b"".join(coder._many(many))]
    for memo in (coder.word, coder.part):
        assert all(len(w) <= memo.longest for w in [*memo, *memo.old])
    assert sum(map(len, coder.word)) <= 100_000 + 1024 and sum(map(len, coder.word.old)) <= 100_000 + 1024
