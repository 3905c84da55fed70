"""The registered queries of this folder: each applies an operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, chat, decontaminate, exact_dedup, hilbert, langid, pieces, pii, quality_model, rules, simhash, spelling, token_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, table: str = "documents", sql: str | None = None):
    """Register a function of one table of the folder."""

    def register(fn: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op8_simhash_vp_forest")
def op8(docs: DataFrame) -> DataFrame:
    rows = simhash.near_duplicates(docs.select("doc_id", "text"))
    print_hex = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select("doc_id", print_hex.alias("fingerprint"), F.col("first.id").alias("component_id"))


@query("op6_line_first_rules", sql=rules.RULES_SQL)
def op6(docs: DataFrame) -> DataFrame:
    judged = rules.quality_rules(docs.select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_chars", "base_failed", "kept")


@query("op10_pieces_by_agenda")
def op10(docs: DataFrame) -> DataFrame:
    coded = pieces.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op1(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, items)


QUERIES["op1_simhash_windows"] = op1


@query("op4_deobfuscated_spans")
def op4(docs: DataFrame) -> DataFrame:
    rows = pii.find_personal(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.KINDS]
    return rows.select("doc_id", *counts, F.sha2(F.encode(pii.joined(base), "UTF-8"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


@query("op7_snapshot_collapse", "conversations", sql=chat.CHAT_SQL)
def op7(turns: DataFrame) -> DataFrame:
    return chat.format_chats(turns)


@query("op9_hilbert_shards")
def op9(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "lang", "source", "n_chars", (F.octet_length(text) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    dealt = hilbert.hilbert_shards(rows, ["lang", "source", "n_chars"], 40, [F.col("text_crc32"), F.col("doc_id")])
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op5_elias_fano_ids")
def op5(docs: DataFrame) -> DataFrame:
    folder = token_store.id_folder(docs.sparkSession)
    manifest = token_store.write_ids(docs, public_tokenizers.path("word_bpe_49k.json"), folder, end_id=1)
    return token_store.read_ids(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query("op2_word_first_backoff")
def op2(docs: DataFrame) -> DataFrame:
    held_out = langid.fold(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    fold = langid.fold
    scored = quality_model.fit_and_score(docs.select("doc_id", "text"), labels, lambda c: fold(c, 5) == 0, lambda c: fold(c, 5) == 4)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


QUERIES["op3_random_fourier_ridge"] = op3


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query("op11_polynomial_duplicates", sql=exact_dedup.EXACT_SQL)
def op11(docs: DataFrame) -> DataFrame:
    norm = F.translate(F.coalesce("text", F.lit("")), LETTERS, LETTERS.lower())
    rows = docs.select("doc_id", F.sha2(F.encode(norm, "UTF-8"), 256).alias("text_sha256"), "text")
    return exact_dedup.exact_duplicates(rows).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op13_bitsliced_variants")
def op13(docs: DataFrame) -> DataFrame:
    return spelling.spelling_variants(docs, garble=31)


def op12(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    return ball_tree.ranked_search(docs, items)


QUERIES["op12_ball_tree_search"], SQL["op12_ball_tree_search"] = op12, ball_tree.RANKED_SQL
