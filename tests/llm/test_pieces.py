import random
from array import array

import numpy as np
import public_tokenizers
import pytest
from helpers import ODD_TEXTS, documents, repeated_rows
from pyspark.sql import functions as F

from labelflow.llm.pieces import Pieces, encode

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return Pieces(PATH)


def odd_texts():
    rng = random.Random(8)
    made = ["".join(rng.choice(" ▁aeinthrs.,\n<>/0é日😀") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    return [t or "" for t in ODD_TEXTS] + ["  a  b ", "<s> hi </s> <unk>", "▁▁ x▁", "\x00", "�", "\xa0", "<0x0A>", "aaaa" * 200, *made]


def encoded(model, texts):
    ids, ends = model.encode(texts)
    return [i.tolist() for i in np.split(ids, ends[:-1])]


def test_ids_are_those_of_the_library(model):
    texts = odd_texts()
    assert encoded(model, texts) == model.library.encode(texts, add_bos=True, add_eos=True)
    for t in texts[:30]:
        assert encoded(model, [t]) == [model.library.encode(t, add_bos=True, add_eos=True)]
    plain = [t for t in texts if "  " not in t and "▁" not in t]
    assert encoded(model, plain) == model.library.encode(plain, add_bos=True, add_eos=True)
    model.check()


def test_ids_do_not_depend_on_what_is_remembered(model):
    small = Pieces(PATH)
    small.word.limit = small.part.limit = 3
    assert encoded(small, odd_texts()[:200]) == encoded(model, odd_texts()[:200])


def test_the_check_finds_wrong_ids(model):
    broken = Pieces(PATH)
    broken.cost = {}  # merges nothing
    broken.encode(["the other one"])
    with pytest.raises(ValueError, match="library"):
        broken.check()


def test_words_of_known_parts_are_compared_as_well():
    broken = Pieces(PATH)
    broken.encode(["a 日"])
    broken.check()
    broken.part["日"] = broken.part["▁a"]  # what is remembered goes wrong
    broken.encode(["a日"])
    with pytest.raises(ValueError, match="library"):
        broken.check()


def test_pieces_across_a_blank_are_refused(tmp_path):
    import sentencepiece

    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(["in the end of the day in the end"] * 50), model_prefix=str(tmp_path / "across"), vocab_size=300, model_type="bpe",
        byte_fallback=True, split_by_whitespace=False, hard_vocab_limit=False, minloglevel=2)
    with pytest.raises(ValueError, match="blank"):
        Pieces(str(tmp_path / "across.model"))


def test_rows_keep_their_columns_and_number(spark, model):
    texts = [t or None for t in odd_texts()[:60]]
    docs = repeated_rows(spark, texts).withColumn("ids", F.lit("old")).withColumn("_text", F.lit("mine"))
    out = encode(docs, PATH)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", "_text", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]] or ""
            assert array("I", bytes(r["ids"])).tolist() == encoded(model, [t])[0]
            assert r["decoded"] == model.library.decode(model.library.encode(t, add_bos=True, add_eos=True))
    assert encode(docs.limit(0), PATH).count() == 0
    assert [bytes(r["ids"]) for r in encode(documents(spark, [None]), PATH).collect()] == [array("I", [1, 2]).tobytes()]
