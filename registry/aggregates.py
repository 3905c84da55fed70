"""Counts, profiles, order, limits and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow import operators as O
from labelflow import plans as P
from labelflow.settings import fresh_path

from . import Tables, query
from .derived import ORDER_LABELS, RECORDS, joined, order_labels, places, records

ITEMS = f"{ORDER_LABELS}, items AS (SELECT id, unnest(labels) AS label FROM order_labels)"


@query("A2_label_frequency", f"WITH {ITEMS} SELECT label, count(*) AS count FROM items GROUP BY label")
def a2(t: Tables):
    return O.label_frequency(order_labels(t), "labels")


@query("A3_label_statistics", f"""WITH {ITEMS} SELECT label, count(*) AS count,
  round(count(*) * 100.0 / (SELECT count(*) FROM orders), 2) AS percentage FROM items GROUP BY label""")
def a3(t: Tables):
    all_orders = O.merge_on_id(t.orders.select(F.col("o_orderkey").alias("id")), order_labels(t))
    return O.label_statistics(all_orders, "labels")


@query("A4_labelled_share", f"""WITH {ORDER_LABELS} SELECT (SELECT count(*) FROM orders) AS records, count(*) AS labelled,
  round(count(*) * 100.0 / (SELECT count(*) FROM orders), 2) AS percentage FROM order_labels""")
def a4(t: Tables):
    return O.labelled_share(O.merge_on_id(t.orders.select(F.col("o_orderkey").alias("id")), order_labels(t)), "labels")


@query("A5_value_counts", f"WITH {RECORDS} SELECT title AS value, count(*) AS count FROM records WHERE title IS NOT NULL GROUP BY 1")
def a5(t: Tables):
    return O.value_counts(records(t), "title")


@query("A6_top_values", "SELECT source AS value, count(*) AS count FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def a6(t: Tables):
    return O.top_values(t.documents, "source", 10)


COLUMNS = {"id": "bigint", **dict.fromkeys(("url", "source", "title", "content", "created_at", "domain", "metadata"), "string")}


def of_columns(select: str) -> str:
    """The select of each column, all together."""
    return f"WITH {RECORDS} " + " UNION ALL ".join(select.format(c=c, t=t) for c, t in COLUMNS.items())


@query("A7_null_counts", of_columns("""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls FROM records"""))
def a7(t: Tables):
    return O.null_counts(records(t))


@query("A8_column_info", of_columns("""SELECT '{c}' AS "column", count({c}) AS non_null, '{t}' AS type FROM records"""))
def a8(t: Tables):
    return O.column_info(records(t))


SUMMARY = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6)::DOUBLE AS min,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75,
  round(max({c}), 6)::DOUBLE AS max FROM {t}"""
_ROUNDED = ("mean", "std", "min", "q25", "q50", "q75", "max")


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c in _ROUNDED else c for c in df.columns])


@query("A9_numeric_summary", " UNION ALL ".join(SUMMARY.format(c=c, t="lineitem") for c in ("l_quantity", "l_discount", "l_tax")))
def a9(t: Tables):
    return rounded(O.numeric_summary(t.lineitem, ["l_quantity", "l_discount", "l_tax"]))


@query("A9_numeric_summary_sorted", SUMMARY.format(c="o_totalprice", t="orders"))
def a9_sorted(t: Tables):
    return rounded(O.numeric_summary(t.orders, ["o_totalprice"], max_distinct=1000))


@query("A10_tag_totals", """SELECT 'tags' AS "column", 2 * count(*) FILTER (lang <> 'fr') AS items, count(*) FILTER (lang <> 'fr') AS records_with_items,
  round(count(*) FILTER (lang <> 'fr') * 100.0 / count(*), 2) AS percentage, round(2.0 * count(*) FILTER (lang <> 'fr') / count(*), 2) AS mean_length FROM documents""")
def a10(t: Tables):
    return O.list_totals(records(t).select(L.extract_tags("metadata", "tags").alias("tags")), ["tags"])


@query("A11_A12_list_totals", f"""WITH {ORDER_LABELS}, n AS (SELECT len(labels) AS a, 1 AS b FROM order_labels)
SELECT 'labels' AS "column", sum(a)::BIGINT AS items, count(*) AS records_with_items, 100.0::DOUBLE AS percentage, round(avg(a), 2) AS mean_length FROM n
UNION ALL SELECT 'nation', count(*), count(*), 100.0, 1.0 FROM n""")
def a11(t: Tables):
    return O.list_totals(order_labels(t).withColumn("nation", F.slice("labels", -1, 1)), ["labels", "nation"])


@query("A13_invalid_dates", "SELECT count(*) AS invalid_dates FROM documents WHERE lang = 'es'")
def a13(t: Tables):
    return O.invalid_dates(records(t).select(L.parse_time("created_at").alias("dt")), "dt")


@query("A14_cluster_sizes", "SELECT label AS cluster_id, count(*) AS count FROM embeddings GROUP BY label")
def a14(t: Tables):
    return O.cluster_sizes(t.embeddings.select(F.col("label").alias("cluster_id")))


@query("A15_cluster_labels", """
WITH marks AS (SELECT source, CASE WHEN quality = 1 THEN 'good' END AS label FROM documents LEFT JOIN labels USING (doc_id)
  UNION ALL SELECT source, CASE WHEN toxic = 1 THEN 'toxic' END FROM documents LEFT JOIN labels USING (doc_id)
  UNION ALL SELECT 'none', NULL FROM documents)
SELECT source AS cluster_id, CASE WHEN count(label) = 0 THEN 'None' ELSE array_to_string(list_sort(list(DISTINCT label) FILTER (label IS NOT NULL)), ', ') END AS labels_text
FROM marks GROUP BY source""")
def a15(t: Tables):
    marked = t.documents.join(t.labels, "doc_id", "left").select(
        F.col("source").alias("cluster_id"),
        F.array_compact(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic"))).alias("labels"),
    )
    bare = t.documents.select(F.lit("none").alias("cluster_id"), L.empty_strings().alias("labels"))
    return O.cluster_labels(marked.unionByName(bare), "labels").select("cluster_id", "labels_text")


@query("A16_top_items", f"WITH {ITEMS} SELECT label AS item, count(*) AS count FROM items GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def a16(t: Tables):
    return O.top_items(order_labels(t), "labels", 20)


@query("A17_labels_in_use", f"WITH {ITEMS} SELECT DISTINCT label FROM items")
def a17(t: Tables):
    return O.labels_in_use(order_labels(t), "labels")


@query("A18_cluster_count", "SELECT count(DISTINCT label) - 1 AS clusters FROM embeddings")
def a18(t: Tables):
    return O.cluster_count(t.embeddings.select((F.col("label") - 1).alias("cluster_id")))


SAMPLED = "row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || ':42'), doc_id)"


@query("A19_joined_samples", f"""
WITH s AS (SELECT source, text, {SAMPLED} AS rank FROM documents QUALIFY rank <= 5)
SELECT source, string_agg(text, '. ' ORDER BY rank) AS sample_text FROM s GROUP BY source""")
def a19(t: Tables):
    drawn = O.sample_per_group(t.documents, "source", "doc_id", 5)
    return O.joined_samples(drawn, "source", "text")


RUN_STATISTICS = f"""WITH {ORDER_LABELS} SELECT count(*) AS records, (SELECT count(*) FROM (SELECT r_name FROM region UNION SELECT n_name FROM nation UNION SELECT s_name FROM supplier)) AS labels_available,
  sum(len(labels))::BIGINT AS labels_assigned, round(avg(len(labels)), 2) AS mean_labels, 'run-1' AS run_id FROM order_labels"""


@query("A20_run_statistics", RUN_STATISTICS)
def a20(t: Tables):
    return O.run_statistics(order_labels(t), places(t), "labels", "run-1")


@query("A20_observed_statistics", RUN_STATISTICS)
def a20_observed(t: Tables):
    return O.write_with_statistics(order_labels(t), places(t), "labels", "run-1")[1]


def label_pairs_sql(least: int) -> str:
    return f"""WITH {ORDER_LABELS}, said AS (SELECT DISTINCT id, unnest(labels) AS label FROM order_labels), counts AS (SELECT label, count(*) AS n FROM said GROUP BY 1),
pairs AS (SELECT a.label AS label_a, b.label AS label_b, count(*) AS together FROM said a JOIN said b ON a.id = b.id AND a.label < b.label GROUP BY ALL HAVING count(*) >= {least})
SELECT label_a, label_b, together, x.n AS count_a, y.n AS count_b, round(together * (SELECT count(*) FROM order_labels) / (x.n * y.n::DOUBLE), 6) AS lift
FROM pairs JOIN counts x ON x.label = label_a JOIN counts y ON y.label = label_b"""


for _least in (1, 40):

    @query(f"A2_label_pairs_{_least}", label_pairs_sql(_least))
    def a2_pairs(t: Tables, least=_least):
        return O.label_pairs(order_labels(t), "labels", least)


# -- order, limit, sample -------------------------------------------------------------------------

@query("L1_sort_rows", f"WITH {RECORDS} SELECT id, title, created_at FROM records ORDER BY title NULLS LAST, created_at DESC NULLS LAST, id")
def l1(t: Tables):
    return O.sort_rows(records(t).select("id", "title", "created_at"), {"title": True, "created_at": False, "id": True})


@query("L2_cap_list", f"WITH {ORDER_LABELS} SELECT id, array_to_string(labels[1:2], '|') AS labels FROM order_labels")
def l2(t: Tables):
    return order_labels(t).select("id", joined(F.slice("labels", 1, 2)).alias("labels"))


@query("L3_first_rows", "SELECT page_id, url FROM pages ORDER BY url LIMIT 10")
def l3(t: Tables):
    return O.first_rows(t.pages.select("page_id", "url"), 10, {"url": True})


@query("L4_sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 100")
def l4(t: Tables):
    return O.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 100)


@query("L4_sample_fraction", "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey || ':42'), 1, 8))::BIGINT / 4294967296.0 < 0.1")
def l4_fraction(t: Tables):
    return O.sample_fraction(t.orders.select("o_orderkey"), "o_orderkey", 0.1)


@query("L5_sample_per_group", f"SELECT doc_id, source, ({SAMPLED})::INT AS rank FROM documents QUALIFY rank <= 5")
def l5(t: Tables):
    return O.sample_per_group(t.documents.select("doc_id", "source"), "source", "doc_id", 5)


@query("L6_top_labels", f"WITH {ITEMS} SELECT label, count(*) AS count FROM items GROUP BY label ORDER BY 2 DESC, 1 LIMIT 5")
def l6(t: Tables):
    return O.label_frequency(order_labels(t), "labels").limit(5)


@query("L7_resumed_run", """SELECT doc_id, length(text) AS chars, upper(lang) AS lang, 'done' AS state FROM documents
UNION ALL SELECT NULL, (SELECT count(*) FROM documents), 'ROWS', 'before and now'""")
def l7_resumed(t: Tables):
    """Two batches, then the rest in a second run on the same path."""
    path = fresh_path(t.spark, "batches")

    def step(rows):
        return rows.select("content_key", "doc_id", F.char_length("text").cast("bigint").alias("chars"), F.upper("lang").alias("lang"))

    docs = t.documents.select("doc_id", "text", "lang")
    size = max(1, docs.count() // 5)
    P.run_batches(docs, step, path, batch_rows=size, most=2)
    again = P.run_batches(docs, step, path, batch_rows=size)
    told = t.spark.range(1).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(again.rows_before + again.rows_done).cast("bigint").alias("chars"), F.lit("ROWS").alias("lang"), F.lit("before and now").alias("state"))
    return again.rows.withColumn("state", F.lit("done")).unionByName(told)


@query("L7_batches", "SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) // 500)::BIGINT AS batch_id FROM events")
def l7(t: Tables):
    return O.with_batches(t.events.select("event_id"), "event_id", 500)
