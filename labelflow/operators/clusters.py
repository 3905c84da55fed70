"""Cluster themes, taxonomy gaps and entity harvest: one grouped job each, no loop over clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import empty_strings, escape_prompt, is_none_reply, or_empty, split_items, words
from ..sources.sinks import SUGGESTION_COLUMNS
from ..settings import written
from .replies import Provider, entity_reply, extract_fields, fill_template, one_reply, theme_reply
from .skew import join_unique
from .stats import cluster_labels, joined_samples, sample_per_group, sample_rows, top_items

__all__ = ["cluster_samples", "cluster_terms", "cluster_themes", "gap_requests", "gap_suggestions", "entity_harvest", "pattern_gaps"]

THEMES = "cluster_theme string, subtopics array<string>"
GAPS = "potential_new_entities string, thematic_gap_suggestions string"
ENTITIES = "extracted_entities array<string>, entity_categories map<string,array<string>>"

GAP_PROMPT = (
    "These texts belong together; the labels [{labels}] are in use for them.\n"
    'Answer with a JSON object: "potential_new_entities", a list of specific new entities, and\n'
    '"thematic_gap_suggestions", a list of themes without a label, each as "name: description".\n\nTexts:\n{text}\n'
)


def cluster_samples(df: DataFrame, text: str, n: int, *, key: str = "id", cluster: str = "cluster_id", seed: int = 42,
                    separator: str = " ") -> DataFrame:
    """Per cluster its size and at most ``n`` sampled texts joined: ``cluster, sample_text, record_count``."""
    members = df.filter(F.col(cluster) != -1)
    sizes = members.groupBy(cluster).agg(F.count(F.lit(1)).alias("record_count"))
    drawn = sample_per_group(members.select(key, cluster, text), cluster, key, n, seed)
    return joined_samples(drawn, cluster, text, separator=separator).join(sizes, cluster)


def cluster_terms(df: DataFrame, text: str, n: int, *, cluster: str = "cluster_id", min_length: int = 1) -> DataFrame:
    """The ``n`` words that tell each cluster from the others: ``cluster, word, count, score, rank``.

    Class-based TF-IDF over all texts: the share of the word in the words of the cluster, times
    ``ln(1 + a / f)`` with its count ``f`` in all clusters and the mean number ``a`` of words in a cluster.
    Words are counted per cluster in the tasks that read them; the other tables are made from these counts.
    Unclustered rows (-1) and words shorter than ``min_length`` don't count; ties go by word.
    """
    spoken = df.filter(F.col(cluster) != -1).select(cluster, F.explode(words(text)).alias("word")).filter(F.char_length("word") >= min_length)
    counts = written(spoken.groupBy(cluster, "word").agg(F.count(F.lit(1)).alias("count")), "cluster_words")
    sizes = counts.groupBy(cluster).agg(F.sum("count").alias("_size"))
    mean = sizes.agg(F.avg("_size")).scalar()
    overall = counts.groupBy("word").agg(F.sum("count").alias("_all"), F.count(F.lit(1)).alias("_rows"))
    rare = F.log(1 + mean / F.col("_all"))
    # a word is in as many rows as clusters have it; one row per cluster in the other table
    weighed = join_unique(counts, overall.select("word", rare.alias("_rare"), "_rows"), "word", "_rows", counts.count())
    score = F.round(F.col("count") / F.col("_size") * F.col("_rare"), 9)
    scored = weighed.join(sizes, cluster).select(cluster, "word", "count", score.alias("score"))
    rank = F.row_number().over(Window.partitionBy(cluster).orderBy(F.col("score").desc(), "word"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= n)


def _term_themes(samples: DataFrame, df: DataFrame, text: str, cluster: str, subtopics: int = 5) -> DataFrame:
    terms = cluster_terms(df, text, subtopics + 1, cluster=cluster)
    lists = terms.groupBy(cluster).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "word"))), lambda e: e["word"]).alias("_l"))
    named = lists.select(cluster, F.get("_l", F.lit(0)).alias("cluster_theme"), F.slice("_l", 2, subtopics).alias("subtopics"))
    return samples.join(named, cluster, "left").select(cluster, "sample_text", "record_count", "cluster_theme", or_empty("subtopics").alias("subtopics"))


def cluster_themes(df: DataFrame, text: str, *, n: int = 5, key: str = "id", cluster: str = "cluster_id", seed: int = 42,
                   provider: Provider | None = None) -> DataFrame:
    """Theme and subtopics of each non-empty cluster: by its own terms (see ``cluster_terms``, over all texts),
    or read from a provider's reply over sampled texts."""
    samples = cluster_samples(df, text, n, key=key, cluster=cluster, seed=seed)
    if provider is None:
        return _term_themes(samples, df, text, cluster)
    requests = samples.select(F.col(cluster).cast("string").alias("request_id"), F.col("sample_text").alias("text"))
    replies = extract_fields(one_reply(provider(requests)), THEMES)
    answers = replies.select("request_id", "cluster_theme", or_empty("subtopics").alias("subtopics"))
    return (
        samples.withColumn("request_id", F.col(cluster).cast("string")).join(answers, "request_id", "left")
        .select(cluster, "sample_text", "record_count", "cluster_theme", or_empty("subtopics").alias("subtopics"))
    )


def gap_requests(df: DataFrame, text: str, labels: str, *, n: int = 10, key: str = "id", cluster: str = "cluster_id",
                 seed: int = 42) -> DataFrame:
    """One request per cluster whose sample is not blank, with the labels in use."""
    samples = cluster_samples(df, text, n, key=key, cluster=cluster, seed=seed, separator=". ")
    used = cluster_labels(df.filter(F.col(cluster) != -1).select(cluster, labels), labels, cluster)
    joined = samples.filter(F.trim("sample_text") != "").join(used, cluster)
    slots = {"labels": escape_prompt("labels_text"), "text": escape_prompt("sample_text")}
    prompt = fill_template(GAP_PROMPT, slots)
    return joined.select(
        F.col(cluster).cast("string").alias("request_id"), F.col(cluster), F.col("record_count").alias("cluster_size"),
        F.col("labels").alias("assigned_labels_in_cluster"), F.col("sample_text").alias("text"), prompt.alias("prompt"),
    )


def gap_suggestions(requests: DataFrame, replies: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """New entities and missing themes per cluster, and ``reply_status``: ``ok``, ``unreadable`` (not
    the JSON asked for) or ``missing`` (no good reply). Every requested cluster has a row.

    Both fields may be JSON lists, or text, which is cut at commas (entities) and line ends (themes).
    """
    read = extract_fields(one_reply(replies).filter("status = 'ok'"), GAPS)

    def items(column: str, separator: str):
        c = F.col(column)
        listed = F.from_json(F.when(F.ltrim(c).startswith("["), c), "array<string>")
        kept = F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "") & ~is_none_reply(x))
        text = F.when(c.isNull() | is_none_reply(c), empty_strings()).otherwise(split_items(c, separator))
        return F.coalesce(kept, text)

    parsed = read.select(
        "request_id", "parsed", items("potential_new_entities", ",").alias("potential_new_entities"),
        items("thematic_gap_suggestions", "\n").alias("thematic_gap_suggestions"),
    )
    status = F.when(F.col("parsed"), "ok").when(F.col("parsed").isNotNull(), "unreadable").otherwise("missing")
    out = requests.join(parsed, "request_id", "left").withColumnRenamed(cluster, "cluster_id").withColumn("reply_status", status)
    for c in ("potential_new_entities", "thematic_gap_suggestions"):
        out = out.withColumn(c, or_empty(c))
    return out.select(*SUGGESTION_COLUMNS, "reply_status")


def pattern_gaps() -> Provider:
    """Provider for gap requests: names in the sample, and its theme words as missing themes."""

    def answer(requests: DataFrame) -> DataFrame:
        named = extract_fields(entity_reply(requests), ENTITIES).select("request_id", "extracted_entities")
        theme = extract_fields(theme_reply(1)(requests), THEMES).select("request_id", "cluster_theme")
        missing = F.concat(F.col("cluster_theme"), F.lit(": frequent word of the cluster"))
        body = F.to_json(F.struct(
            F.array_sort("extracted_entities").alias("potential_new_entities"),
            F.filter(F.array(missing), lambda x: x.isNotNull()).alias("thematic_gap_suggestions"),
        ))
        return named.join(theme, "request_id").select("request_id", body.alias("reply"), F.lit("ok").alias("status"))

    return answer


def entity_harvest(df: DataFrame, text: str, *, n: int = 20, top: int = 20, key: str = "id", seed: int = 42,
                   provider: Provider | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities of ``n`` sampled records: per record, the most frequent, and the count per category."""
    drawn = sample_rows(df.select(key, text), key, n, seed)
    requests = drawn.select(F.col(key).cast("string").alias("request_id"), F.col(text).alias("text"))
    read = extract_fields(one_reply((provider or entity_reply)(requests)), ENTITIES)
    found = read.select("request_id", or_empty("extracted_entities").alias("extracted_entities"), "entity_categories")
    by_category = (
        found.select(F.explode("entity_categories").alias("category", "entities"))
        .select("category", F.explode("entities").alias("entity"))
        .groupBy("category").agg(F.count(F.lit(1)).alias("count"))
    )
    return found, top_items(found, "extracted_entities", top), by_category
