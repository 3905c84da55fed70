"""Model-backed steps as table jobs: build requests, hand them to a provider, read the replies.

``requests``: ``request_id, id, prompt`` (and the columns a provider may use); ``request_id`` is the
record id as text.
``replies``:  ``request_id, reply, status`` with status ``ok`` or ``error``.
A provider is a function from the requests DataFrame to the replies DataFrame. A request that was
retried or logged twice may have several replies; the steps that read replies take one for each
request (:func:`one_reply`). Providers made here that look at the text alone say so with
``reads_prompt = False``, and no prompt is built for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import (
    blank_to_empty, empty_strings, escape_prompt, is_none_reply, label_plus_desc, or_empty, split_items, words,
)
from ..settings import measure, salt_values, setting
from .keywords import match_keywords, term_overlap
from .lookup import map_list, valid_items
from .numbering import numbered

__all__ = [
    "Provider", "batch_provider", "replay_provider", "overlap_provider", "without_prompt", "one_reply", "join_pages", "fill_template", "label_block", "classification_requests",
    "verification_requests", "reply_text", "parse_reply", "assign_by_reply", "verify_candidates", "extract_fields",
    "entity_reply", "summary_reply", "theme_reply", "one_line_summary", "mentioned_entities", "entity_categories",
]

Provider = Callable[[DataFrame], DataFrame]
REPLIES = "request_id string, reply string, status string"

CLASSIFY = (
    "Pick the labels that describe the text below.\n\nText:\n{text}\n\nLabels:\n{labels}\n\n"
    "Answer with at most {k} label names, separated by commas, or with None.\n"
)
VERIFY = (
    "Which of the candidate labels fit the text?\n\nText:\n{text}\n\nCandidates:\n{labels}\n\n"
    "Answer with the fitting names as written above, separated by commas, or with NONE.\n"
)


# -- providers --------------------------------------------------------------------------------

def batch_provider(fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Provider:
    """Wrap a function over Arrow batches of requests; the number of partitions bounds how many
    run at once."""
    return lambda requests: requests.mapInPandas(fn, REPLIES)


def without_prompt(provider: Provider) -> Provider:
    """Mark a provider that does not read ``prompt``."""
    provider.reads_prompt = False
    return provider


def replay_provider(logged: DataFrame) -> Provider:
    """Answer from a table of logged replies; a request without one has status ``error``."""

    def answer(requests: DataFrame) -> DataFrame:
        known = one_reply(logged).select("request_id", "reply", "status")
        found = requests.select("request_id").join(known, "request_id", "left")
        return found.withColumn("status", F.coalesce(F.col("status"), F.lit("error")))

    return without_prompt(answer)


def overlap_provider(labels: DataFrame, k: int = 5) -> Provider:
    """Deterministic stand-in for a model: the labels with most terms in the text."""

    def answer(requests: DataFrame) -> DataFrame:
        scored = term_overlap(requests, "text", labels, k, out="_found")
        names = F.array_join("_found", ", ")
        reply = F.when(names == "", F.lit("None")).otherwise(names)
        return scored.select("request_id", reply.alias("reply"), F.lit("ok").alias("status"))

    return without_prompt(answer)


# -- requests ---------------------------------------------------------------------------------

def fill_template(template: str, slots: dict[str, Column]) -> Column:
    """The template with its ``{slots}`` filled; filled-in text is not searched for slots again."""
    parts: list[Column] = []
    rest = template
    while rest:
        at = {n: rest.find("{" + n + "}") for n in slots}
        at = {n: i for n, i in at.items() if i >= 0}
        if not at:
            parts.append(F.lit(rest))
            break
        name = min(at, key=at.get)
        parts += [F.lit(rest[: at[name]]), slots[name]]
        rest = rest[at[name] + len(name) + 2 :]
    return F.concat(*parts)


def _numbered_lines() -> Column:
    """Aggregate: the numbered ``name: description`` list, in taxonomy order."""
    entries = F.array_sort(F.collect_list(F.struct("pos", label_plus_desc("label", "description").alias("line"))))
    return F.array_join(F.transform(entries, lambda e, i: F.concat((i + 1).cast("string"), F.lit(". "), e["line"])), "\n")


def label_block(labels: DataFrame) -> DataFrame:
    """One row: the numbered ``name: description`` list. The list becomes part of every prompt."""
    return labels.agg(_numbered_lines().alias("block"))


def classification_requests(
    df: DataFrame, text: str, labels: DataFrame, k: int = 5, *, key: str = "id", template: str = CLASSIFY,
    prompt: bool = True, page_bytes: int | None = None,
) -> DataFrame:
    """One request per record and page of the label list: ``request_id, id, text, prompt, page``.

    A list of up to ``page_bytes`` (the inline limit unless given) is one page. A longer one is cut in
    taxonomy order into several, each of which makes a request of its own, whose ``request_id`` is the id
    with ``#`` and the page number. :func:`join_pages` puts the replies together, however many pages.
    ``prompt=False`` leaves prompt and page out, for providers that do not read them.
    """
    request = [F.col(key).cast("string").alias("request_id"), F.col(key), F.col(text).alias("text")]
    if not prompt:
        return df.select(*request)
    n, size = measure(labels, "label", "description")
    limit = page_bytes or setting(df.sparkSession, "inlineBytes")
    slots = {"text": blank_to_empty(text), "labels": F.col("_block"), "k": F.lit(str(k))}
    if size <= limit:
        return df.withColumn("_block", label_block(labels).scalar()).select(
            *request, fill_template(template, slots).alias("prompt"), F.lit(1).cast("bigint").alias("page"))
    per_page = max(1, n * limit // size)
    placed = numbered(labels.select("label", "description", "pos"), [F.col("pos").asc(), F.col("label").asc()], "_at")
    placed = placed.withColumn("_page", F.floor(F.col("_at") / per_page).cast("bigint"))
    blocks = placed.groupBy("_page").agg(_numbered_lines().alias("_block"))
    if size <= setting(df.sparkSession, "broadcastBytes"):
        blocks = F.broadcast(blocks)  # the records, a copy for each page, are not shuffled
    asked = df.withColumn("_page", F.explode(salt_values(-(-n // per_page)))).join(blocks, "_page")
    page = F.col("_page") + 1
    return asked.select(
        F.concat(F.col(key).cast("string"), F.lit("#"), page.cast("string")).alias("request_id"), F.col(key), F.col(text).alias("text"),
        fill_template(template, slots).alias("prompt"), page.alias("page"))


def join_pages(requests: DataFrame, replies: DataFrame, key: str = "id") -> DataFrame:
    """One reply per record from the replies to its pages: their items in page order. It counts as
    failed only if every page failed."""
    answered = requests.select("request_id", key, "page").join(one_reply(replies), "request_id")
    good = F.col("status") == "ok"
    said = good & ~F.coalesce(is_none_reply("reply"), F.lit(True)) & (F.trim("reply") != "")
    items = F.array_sort(F.collect_list(F.when(said, F.struct("page", "reply"))))
    whole = answered.groupBy(key).agg(items.alias("_items"), F.max(good).alias("_good"))
    return whole.select(
        F.col(key).cast("string").alias("request_id"), F.array_join(F.transform("_items", lambda e: e["reply"]), ", ").alias("reply"),
        F.when(F.col("_good"), "ok").otherwise("error").alias("status"))


def verification_requests(
    df: DataFrame, text: str, *, key: str = "id", labels: str = "candidate_labels",
    descriptions: str = "candidate_descriptions", template: str = VERIFY,
) -> DataFrame:
    """One request per record that has candidates, listing only its own.

    Descriptions are used when there is one for every candidate.
    """
    names, notes = or_empty(labels), or_empty(descriptions)
    both = F.arrays_zip(names.alias("n"), notes.alias("d"))
    with_notes = F.transform(
        both, lambda e, i: F.concat((i + 1).cast("string"), F.lit(". "), escape_prompt(e["n"]), F.lit(": "), escape_prompt(e["d"]))
    )
    bare = F.transform(names, lambda n, i: F.concat((i + 1).cast("string"), F.lit(". "), escape_prompt(n)))
    block = F.array_join(F.when(F.size(names) == F.size(notes), with_notes).otherwise(bare), "\n")
    prompt = fill_template(template, {"text": escape_prompt(text), "labels": block})
    return df.filter(F.size(names) > 0).select(
        F.col(key).cast("string").alias("request_id"), F.col(key), F.col(text).alias("text"),
        F.col(labels), prompt.alias("prompt"),
    )


# -- replies ----------------------------------------------------------------------------------

def reply_text(c: str | Column) -> Column:
    """Text of a reply that may be plain, or a JSON envelope with a choice list."""
    raw = F.col(c) if isinstance(c, str) else c
    v = F.try_parse_json(raw)
    return F.coalesce(
        F.try_variant_get(v, "$.choices[0].text", "string"),
        F.try_variant_get(v, "$.choices[0].message.content", "string"),
        raw,
    )


def parse_reply(c: str | Column, allowed: Column | None = None, k: int | None = None) -> Column:
    """Reply text to a label list: NONE or nothing gives ``[]``; items are cut at commas and
    trimmed, kept if allowed, and capped at ``k``."""
    raw = F.col(c) if isinstance(c, str) else c
    items = F.when(raw.isNull() | is_none_reply(raw), empty_strings()).otherwise(split_items(raw))
    if allowed is not None:
        items = valid_items(items, allowed)
    return items if k is None else F.slice(items, 1, k)


def one_reply(replies: DataFrame) -> DataFrame:
    """One reply for each request: a good one before a failed one, then the earliest ``attempt`` if
    there is such a column, then the first text. The rank filter keeps one row per request and
    partition before the shuffle, so a request that was logged very often stays cheap."""
    attempt = [F.col("attempt").asc_nulls_last()] if "attempt" in replies.columns else []
    order = [(F.col("status") == "ok").desc_nulls_last(), *attempt, F.col("reply").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("request_id").orderBy(*order))
    return replies.filter("request_id IS NOT NULL").withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def _keyed(replies: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Replies under the record key itself, so that later steps by ``key`` reuse the partitioning."""
    return one_reply(replies).select(F.col("request_id").try_cast(df.schema[key].dataType).alias(key), "reply", "status")


def assign_by_reply(
    df: DataFrame, replies: DataFrame, text: str, labels: DataFrame, k: int = 5, *, key: str = "id",
    out: str = "assigned_labels", fallback_on: tuple[str, ...] = ("none", "error"), on_error: str = "fallback",
    trim_none: bool = True, form: str = "auto",
) -> DataFrame:
    """Labels from replies, with the keyword matcher as fallback.

    ``fallback_on`` may hold ``none`` (reply empty or None), ``error`` (failed or missing reply)
    and ``invalid`` (reply without one valid label). ``on_error='empty'`` gives ``[]`` for failed
    replies. With ``trim_none=False`` a None with blanks around it counts as an unknown label. Only
    records that need it reach the matcher.
    """
    joined = df.join(_keyed(replies, df, key).withColumnsRenamed({"reply": "_reply", "status": "_status"}), key, "left")
    failed = F.coalesce(F.col("_status") != "ok", F.lit(True))
    blank = (F.trim("_reply") if trim_none else F.col("_reply")) == ""
    none = F.coalesce(blank | is_none_reply("_reply", trim_none), F.lit(True))
    parsed = joined.withColumn("_items", F.when(failed, empty_strings()).otherwise(parse_reply("_reply")))
    mapping = labels.select(F.col("label").alias("item")).distinct().select("item", F.array("item").alias("values"))
    checked = map_list(parsed, key, "_items", mapping, "_valid", keep_unmatched=False, as_set=False, form=form)
    fall = F.lit(False)
    if "error" in fallback_on and on_error == "fallback":
        fall = fall | failed
    if "none" in fallback_on:
        fall = fall | (~failed & none)
    if "invalid" in fallback_on:
        fall = fall | (~failed & ~none & (F.size("_valid") == 0))
    # the matcher sees NULL where the reply counts
    body = checked.withColumn("_body", F.when(fall, F.col(text)))
    matched = match_keywords(body, "_body", labels, k, out="_fallback", key=key)
    labels_out = F.when(F.col("_body").isNotNull(), or_empty("_fallback")).otherwise(F.slice("_valid", 1, k))
    return matched.withColumn(out, labels_out).drop("_reply", "_status", "_items", "_valid", "_fallback", "_body")


def verify_candidates(
    df: DataFrame, replies: DataFrame, *, key: str = "id", candidates: str = "candidate_labels",
    out: str = "llm_verified_labels", audit: str = "unknown_labels",
) -> DataFrame:
    """Labels a reply picked among the record's own candidates; picks outside them go to ``audit``.

    No candidates, no reply, a failed reply or NONE give ``[]``.
    """
    answers = _keyed(replies, df, key).filter("status = 'ok'").withColumnRenamed("reply", "_reply").drop("status")
    joined = df.join(answers, key, "left")
    items = F.when(F.size(or_empty(candidates)) > 0, parse_reply("_reply")).otherwise(empty_strings())
    picked = joined.withColumn("_items", items)
    return (
        picked.withColumn(out, valid_items("_items", candidates))
        .withColumn(audit, F.array_sort(F.array_except("_items", or_empty(candidates))))
        .drop("_reply", "_items")
    )


# -- structured extraction --------------------------------------------------------------------

def extract_fields(replies: DataFrame, schema: str | T.StructType, reply: str = "reply") -> DataFrame:
    """Named fields of JSON replies. A reply that does not parse gives NULL fields and ``parsed`` false."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    read = replies.withColumn("_r", F.from_json(reply_text(reply), struct))
    some = F.lit(False)
    for f in struct.fields:
        some = some | F.col(f"_r.{f.name}").isNotNull()
    return read.withColumn("parsed", F.coalesce(some, F.lit(False))).select("*", "_r.*").drop("_r")


_TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}_.+#-]*[\p{L}\p{N}+#]|\p{L}"


def mentioned_entities(text: str | Column) -> Column:
    """Distinct tokens that look like names: a capital letter, or a digit or dot after a letter."""
    raw = F.col(text) if isinstance(text, str) else text
    tokens = F.regexp_extract_all(raw, F.lit(_TOKEN), F.lit(0))
    return F.array_distinct(F.filter(tokens, lambda t: t.rlike(r"\p{Lu}|\p{L}[0-9]|\p{L}\.[\p{L}\p{N}]")))


def _like(pattern: str):
    return lambda token: token.rlike(pattern)


def entity_categories(entities: str | Column) -> Column:
    """Map of category to entities: ``acronym``, ``name``, ``mixed``; empty categories are left out."""
    e = F.col(entities) if isinstance(entities, str) else entities
    rules = {
        "acronym": r"^\p{Lu}{2,}$",
        "name": r"^\p{Lu}[\p{Ll}]*$",
    }
    lists = {n: F.filter(e, _like(p)) for n, p in rules.items()}
    lists["mixed"] = F.filter(e, lambda t: ~t.rlike("|".join(rules.values())))
    entries = F.array(*[F.struct(F.lit(n).alias("k"), v.alias("v")) for n, v in lists.items()])
    return F.map_from_entries(F.filter(entries, lambda x: F.size(x["v"]) > 0))


def entity_reply(requests: DataFrame) -> DataFrame:
    """Provider: entities and their categories as a JSON reply, by pattern."""
    found = requests.withColumn("_e", mentioned_entities("text"))
    body = F.to_json(F.struct(F.col("_e").alias("extracted_entities"), entity_categories("_e").alias("entity_categories")))
    return found.select("request_id", body.alias("reply"), F.lit("ok").alias("status"))


def one_line_summary(text: str | Column) -> Column:
    """The sentence of the whole text with most distinct words; the first of equals."""
    raw = F.col(text) if isinstance(text, str) else text
    sentences = F.regexp_extract_all(raw, F.lit(r"[^.!?\n]+[.!?]?"), F.lit(0))
    scored = F.transform(
        sentences, lambda s, i: F.struct(F.size(F.array_distinct(words(s))).alias("n"), (-i).alias("i"), F.trim(s).alias("s"))
    )
    return F.coalesce(F.array_max(scored)["s"], F.lit(""))


def summary_reply(requests: DataFrame) -> DataFrame:
    """Provider: one-sentence summary."""
    body = F.to_json(F.struct(one_line_summary("text").alias("summary")))
    return requests.select("request_id", body.alias("reply"), F.lit("ok").alias("status"))


def theme_reply(n: int = 5, min_length: int = 1) -> Provider:
    """Provider: most frequent word of each request's text as theme, the next ``n`` as subtopics.

    Words shorter than ``min_length`` don't count; by default all do, as names may be short. Only
    ``n + 1`` words of a request are gathered.
    """

    def answer(requests: DataFrame) -> DataFrame:
        spoken = requests.select("request_id", F.explode(words("text")).alias("w")).filter(F.char_length("w") >= min_length)
        counts = spoken.groupBy("request_id", "w").agg(F.count(F.lit(1)).alias("c"))
        rank = F.row_number().over(Window.partitionBy("request_id").orderBy(F.col("c").desc(), "w"))
        first = counts.withColumn("_rank", rank).filter(F.col("_rank") <= n + 1)
        ranked = first.groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("_rank", "w"))).alias("l"))
        names = F.transform("l", lambda e: e["w"])
        body = F.to_json(F.struct(F.get(names, F.lit(0)).alias("cluster_theme"), F.slice(names, 2, n).alias("subtopics")))
        answered = ranked.select("request_id", body.alias("reply"))
        return requests.select("request_id").join(answered, "request_id", "left").select(
            "request_id", F.coalesce("reply", F.lit("")).alias("reply"), F.lit("ok").alias("status")
        )

    return without_prompt(answer)
