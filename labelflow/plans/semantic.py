"""Label records by vector similarity and by the entities they mention."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookup import combine_lists, match_entities
from ..operators.replies import Provider, extract_fields, mentioned_entities, one_reply
from ..operators.similarity import attach_nearest, rerank_attached
from ..operators.stats import label_statistics
from ..operators.taxonomy import with_label_text
from ..operators.vectors import bucket_words, embed_text, weight_vector
from ..settings import written_together
from ..sources.sinks import run_manifest, write_csv, write_json_lines, write_manifest

__all__ = ["enrich_semantic", "store_semantic"]


def enrich_semantic(
    prepared: DataFrame, labels: DataFrame, k: int = 10, *, dim: int = 256, rerank_from: int | None = None,
    provider: Provider | None = None,
) -> DataFrame:
    """Add the ``k`` nearest labels, mentioned entities, their exact label matches, and the union.

    With ``rerank_from`` the nearest so many labels are ordered anew by common words and the best
    ``k`` kept.

    Without a provider entities are found by pattern, in the record's own row. The prepared table
    is written once with its hashed words, because the word weights need a pass of their own.
    """
    prepared = written_together(prepared.withColumn("_buckets", bucket_words("combined_text", dim)), "prepared")
    weights = weight_vector(prepared, "combined_text", dim, "_buckets")
    points = embed_text(prepared, "combined_text", dim, weights=weights, buckets="_buckets").drop("_buckets")
    targets = embed_text(with_label_text(labels), "label_plus_desc", dim, weights=weights)
    near = attach_nearest(points, targets, rerank_from or k, prefix="ontology_")
    if rerank_from:
        near = rerank_attached(near, "combined_text", k, prefix="ontology_")
    near = near.drop("vector", "ontology_descriptions")
    near = near.withColumnsRenamed({f"ontology_{c}": f"ontology_{c}_k" for c in ("labels", "scores", "paths")})
    if provider is None:
        found = near.withColumn("mentioned_entities", mentioned_entities("combined_text"))
    else:
        requests = near.select(F.col("id").cast("string").alias("request_id"), F.col("combined_text").alias("text"))
        read = extract_fields(one_reply(provider(requests)), "mentioned_entities array<string>")
        lists = read.select("request_id", "mentioned_entities")
        found = near.join(lists, near["id"].cast("string") == lists["request_id"], "left").drop("request_id")
        found = found.withColumn("mentioned_entities", F.coalesce("mentioned_entities", F.array().cast("array<string>")))
    matched = match_entities(found, "id", "mentioned_entities", labels, "keyword_matched_labels")
    return matched.withColumn(
        "combined_ontology_labels", combine_lists("ontology_labels_k", "keyword_matched_labels")
    )


def store_semantic(enriched: DataFrame, path: str, run_id: str) -> DataFrame:
    """Write the flat file, the JSON lines, the label statistics and the run summary; return it.

    The enriched table is computed once; all files are made from the written copy. The flat file and the lines
    hold every text several times and are compressed (gzip).
    """
    enriched = written_together(enriched, "enriched")
    files = {n: f"{path}/{n}" for n in ("enriched_csv", "enriched_jsonl", "label_statistics", "summary")}
    write_json_lines(enriched, files["enriched_jsonl"], "gzip")
    write_csv(enriched, files["enriched_csv"], compression="gzip")
    stats = label_statistics(enriched, "combined_ontology_labels")
    write_csv(stats, files["label_statistics"], skip=())
    listed = {n: p for n, p in files.items() if n != "summary"}
    summary = run_manifest(enriched, listed, run_id, stats)
    write_manifest(summary, files["summary"])
    return enriched.sparkSession.read.json(files["summary"])
