"""Look for what the taxonomy lacks: clusters, their themes, new labels, entities."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from ..operators.clusters import cluster_themes, entity_harvest
from ..operators.replies import Provider
from ..operators.stats import cluster_sizes, labels_in_use, new_label_candidates
from ..operators.vectors import REST, assign_clusters, bucket_words, embed_text, fit_centres, weight_vector
from ..settings import written

__all__ = ["Expansion", "expand"]


class Expansion(NamedTuple):
    clusters: DataFrame
    sizes: DataFrame
    themes: DataFrame
    new_labels: DataFrame
    entities: DataFrame
    top_entities: DataFrame


def expand(
    df: DataFrame, text: str, labels_column: str, *, k: int = 10, dim: int = 256, rounds: int = REST, key: str = "id",
    seed: int = 42, themes: Provider | None = None, entities: Provider | None = None,
) -> Expansion:
    """Cluster the records by content, name the clusters and list themes that are no label in use.

    The centres are trained on a narrow table of the vectors, for at most ``rounds`` rounds; the
    cluster of a record is found in its row."""
    hashed = written(df.select(key, bucket_words(text, dim).alias("_buckets")), "words")
    weights = weight_vector(hashed, text, dim, "_buckets")
    vectors = written(embed_text(hashed, text, dim, weights=weights, buckets="_buckets").drop("_buckets"), "vectors")
    centres = fit_centres(vectors, key, "vector", k, seed=seed, iterations=rounds).points
    assigned = assign_clusters(vectors, "vector", centres).select(key, "cluster_id")
    points = embed_text(df, text, dim, weights=weights)
    named = cluster_themes(assign_clusters(points, "vector", centres).drop("vector"), text, key=key, seed=seed, provider=themes)
    found, top, _ = entity_harvest(df, text, key=key, seed=seed, provider=entities)
    return Expansion(
        assigned, cluster_sizes(assigned), named, new_label_candidates(named, labels_in_use(df, labels_column)), found, top
    )
