import public_tokenizers
from helpers import ODD_TEXTS, documents

from labelflow.llm.batches import worker_state
from labelflow.llm.pieces import Pieces, encode


def test_a_stage_that_keeps_nothing_frees_what_was_kept():
    assert worker_state("words", lambda: {"a": 1}) == {"a": 1}
    seen = []
    worker_state("next", lambda: seen.append(worker_state.__globals__["sys"].modules["_labelflow_worker"].value))
    assert seen == [None]  # forgotten before the next is made
    worker_state("words", lambda: {"a": 1})
    assert worker_state("fingerprints") is None


def test_words_without_a_seam_take_no_room_as_parts():
    pieces = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    pieces.encode(["the house of the king"])
    pieces.check()
    assert pieces.word and "▁the" not in pieces.part


def test_fewer_words_and_shorter_runs_change_no_ids(spark):
    docs = documents(spark, [f"w{i} text{i * 7919} of {'ab' * (i % 9)}\tand {i}" for i in range(300)] + ODD_TEXTS)
    path = public_tokenizers.path("piece_bpe_32k.model")
    few = Pieces(path, 40)
    few.encode([f"word{i}x" for i in range(500)])
    few.check()
    assert max(len(few.word), len(few.word.old)) <= 40 and max(len(few.part), len(few.part.old)) <= 20
    want = {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in encode(docs, path).collect()}
    assert {r["doc_id"]: (bytes(r["ids"]), r["decoded"]) for r in encode(docs, path, words=40, run=200).collect()} == want
