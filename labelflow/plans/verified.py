"""Candidates by similarity, choice by model reply, closure over the hierarchy, gaps per cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import combine_text, summary_text
from ..operators.clusters import gap_requests, gap_suggestions, pattern_gaps
from ..operators.dedup import keep_newest
from ..operators.lookup import close_hierarchy
from ..operators.replies import Provider, extract_fields, one_line_summary, one_reply, verification_requests, verify_candidates
from ..operators.similarity import attach_nearest, rerank_attached
from ..operators.taxonomy import first_by_label, with_label_text
from ..operators.vectors import REST, assign_clusters, bucket_words, embed_text, fit_centres, weight_vector
from ..settings import written
from ..sources.records import as_records, keep_columns, with_row_id
from .prepare import clean_records

__all__ = ["enrich_verified", "with_summaries", "VERIFIED_COLUMNS"]

# Columns of the verified output, in order.
VERIFIED_COLUMNS = [
    "id", "url", "title", "content", "created_at", "cleaned_title", "cleaned_content", "content_summary",
    "summary_and_title", "candidate_labels", "candidate_scores", "candidate_descriptions", "llm_verified_labels",
    "final_ontology_labels", "cluster_id",
]


def with_summaries(df: DataFrame, provider: Provider | None = None, key: str = "id") -> DataFrame:
    """Add ``content_summary`` of each non-blank content (else ``''``) and the texts built on it."""
    if provider is None:
        out = df.withColumn("content_summary", one_line_summary("cleaned_content"))
    else:
        wanted = df.filter(F.trim("cleaned_content") != "")
        requests = wanted.select(F.col(key).alias("request_id"), F.col("cleaned_content").alias("text"))
        read = extract_fields(one_reply(provider(requests)), "summary string").select(F.col("request_id").alias(key), "summary")
        out = df.join(read, key, "left").withColumn("content_summary", F.coalesce("summary", F.lit(""))).drop("summary")
    return out.withColumn("summary_and_title", summary_text("cleaned_title", "content_summary")).withColumn(
        "combined_text", combine_text("cleaned_title", "cleaned_content", trim=False)
    )


def enrich_verified(
    records: DataFrame, labels: DataFrame, provider: Provider, k: int = 15, *, dim: int = 256, clusters: int = 20,
    rounds: int = REST, rerank_from: int | None = None, enforce_hierarchy: bool = False, expand: bool = True,
    summaries: Provider | None = None, gaps: Provider | None = None, mode: str = "parser",
) -> tuple[DataFrame, DataFrame | None]:
    """The verified table and, when ``expand`` is set, the gap suggestions per cluster.

    Candidates are the labels nearest to title and summary; with ``rerank_from`` the nearest so many
    are ordered anew by common words and the best ``k`` kept. Requests show the combined text.

    The record table is written once and the replies (narrow) once; vectors, candidates, closure and
    clusters are made in the row when the result is written. The clusters are trained on a narrow
    table of the vectors, for at most ``rounds`` rounds.
    """
    unique_labels = written(first_by_label(labels), "labels")
    cleaned = keep_newest(clean_records(as_records(records), mode), "url", "created_at_dt")
    told_rows = with_summaries(with_row_id(cleaned), summaries)
    base = written(told_rows.withColumn("_buckets", bucket_words("summary_and_title", dim)), "summaries")
    told = F.trim("summary_and_title") != ""
    weights = weight_vector(base.filter(told), "summary_and_title", dim, "_buckets")
    targets = embed_text(with_label_text(unique_labels), "label_plus_desc", dim, weights=weights)
    points = embed_text(base, "summary_and_title", dim, weights=weights, buckets="_buckets").drop("_buckets")
    candidates = attach_nearest(points, targets, rerank_from or k)
    if rerank_from:
        candidates = rerank_attached(candidates, "summary_and_title", k)

    replies = written(one_reply(provider(verification_requests(candidates, "combined_text"))), "replies")
    verified = verify_candidates(candidates, replies)
    final = close_hierarchy(
        verified, "id", "llm_verified_labels", unique_labels, "final_ontology_labels", enabled=enforce_hierarchy
    )
    if not expand:
        return keep_columns(final.withColumn("cluster_id", F.lit(-1)), VERIFIED_COLUMNS)[0], None

    vectors = written(points.filter(told).select("id", "vector"), "cluster_vectors")
    centres = fit_centres(vectors, "id", "vector", clusters, iterations=rounds).points
    assigned = assign_clusters(final.withColumn("vector", F.when(told, F.col("vector"))), "vector", centres)
    stored = written(keep_columns(assigned, VERIFIED_COLUMNS)[0], "verified")
    requests = gap_requests(stored, "summary_and_title", "final_ontology_labels")
    return stored, gap_suggestions(requests, (gaps or pattern_gaps())(requests))
