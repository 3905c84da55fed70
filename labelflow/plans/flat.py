"""Label records by model reply, with the keyword matcher as fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.replies import Provider, assign_by_reply, classification_requests, join_pages
from ..settings import written
from .prepare import FLAT_COLUMNS, prepare

__all__ = ["enrich_flat"]


def enrich_flat(
    records: DataFrame, labels: DataFrame, provider: Provider, k: int = 5, *, mode: str = "parser",
    tag_key: str = "raindrop_tags", fallback_on: tuple[str, ...] = ("none", "error"), prepared: bool = False,
) -> DataFrame:
    """Prepared records with ``assigned_labels``, the flat output columns in order.

    Requests and labelling both read the prepared table, so it is written once; hand in a stored
    one with ``prepared=True``. A label list too long for one prompt is asked page by page.
    """
    base = records if prepared else written(prepare(records, mode=mode, tag_key=tag_key), "prepared")
    requests = classification_requests(base, "combined_text", labels, k, prompt=getattr(provider, "reads_prompt", True))
    replies = provider(requests)
    if "page" in requests.columns:
        replies = join_pages(requests, replies)
    labelled = assign_by_reply(base, replies, "combined_text", labels, k, fallback_on=fallback_on)
    return labelled.select(*FLAT_COLUMNS, "assigned_labels")
