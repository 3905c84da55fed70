"""Whole user-level plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import plans as P
from labelflow.operators.vectors import REST
from labelflow.settings import fresh_path

from . import Tables, query
from .derived import CLEANED, PLACES, PREPARED, RECORDS, joined, passages, places, records
from .models import AT_REST, DIM, LOOKS_NAMED, TERMS, TOKEN, embed_sql, entities_sql, kmeans_ctes, logged, samples_sql, weights_sql

PREPARED_ROWS = f"""WITH {PREPARED}
SELECT id, url, cleaned_title, cleaned_content, created_us, combined_text,
  CASE WHEN json_type(metadata, '$.tags') = 'ARRAY' THEN array_to_string(json_extract_string(metadata, '$.tags[*]'), '|') ELSE '' END AS existing_tags FROM prepared"""


@query("W1_prepare", PREPARED_ROWS)
def w1(t: Tables):
    done = P.prepare(records(t), tag_key="tags")
    return done.select("id", "url", "cleaned_title", "cleaned_content", F.unix_micros("created_at_dt").alias("created_us"),
                       "combined_text", joined("existing_tags").alias("existing_tags"))


PREPARATION = f"""WITH {CLEANED}, told AS (SELECT *, (cleaned_title <> '' OR cleaned_content <> '') AS ok FROM cleaned)
SELECT 'read' AS stage, count(*) AS n FROM told UNION ALL SELECT 'empty', count(*) FILTER (NOT ok) FROM told
UNION ALL SELECT 'invalid_dates', count(*) FILTER (ok AND created_us IS NULL) FROM told
UNION ALL SELECT 'duplicates', count(*) FILTER (ok) - count(DISTINCT url) FILTER (ok) FROM told
UNION ALL SELECT 'prepared', count(DISTINCT url) FILTER (ok) FROM told"""


@query("W1_preparation_counts", PREPARATION)
def w1_counts(t: Tables):
    return P.preparation_counts(records(t))


@query("W1_D4_observed_counts", PREPARATION)
def w1_observed(t: Tables):
    return P.prepare_counted(records(t), tag_key="tags")[1]


@query("W1_D4_counted_rows", PREPARED_ROWS)
def w1_counted(t: Tables):
    done = P.prepare_counted(records(t), tag_key="tags")[0]
    return done.select("id", "url", "cleaned_title", "cleaned_content", F.unix_micros("created_at_dt").alias("created_us"),
                       "combined_text", joined("existing_tags").alias("existing_tags"))


PREPARED_KEYWORDS = rf"""{PREPARED}, terms AS (
  SELECT item_id AS pos, 'Passage_' || item_id AS label,
    unnest(list_concat(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: length(w) > 3), ['passage', item_id::VARCHAR])) AS term FROM benchmark),
hits AS (SELECT DISTINCT id, pos, label FROM prepared, terms WHERE contains(lower(combined_text), term)),
top AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) <= 5),
labelled AS (SELECT p.id, list(label ORDER BY pos) FILTER (label IS NOT NULL) AS labels FROM prepared p LEFT JOIN top ON top.id = p.id GROUP BY p.id)"""


FLAT_LABELS = f"""WITH {PREPARED_KEYWORDS}
SELECT k.id, p.combined_text, CASE WHEN json_type(p.metadata, '$.tags') = 'ARRAY' THEN array_to_string(json_extract_string(p.metadata, '$.tags[*]'), '|') ELSE '' END AS existing_tags,
  coalesce(CASE WHEN m.doc_id IS NULL OR toxic = 1 THEN array_to_string(k.labels, '|')
  WHEN quality = 1 THEN 'Passage_1|Passage_2|Passage_1' ELSE '' END, '') AS assigned_labels
FROM labelled k JOIN prepared p ON p.id = k.id LEFT JOIN labels m ON m.doc_id = k.id"""


@query("W2_enrich_flat", FLAT_LABELS)
def w2(t: Tables):
    done = P.enrich_flat(records(t), passages(t), O.replay_provider(logged(t)), tag_key="tags")
    return done.select("id", "combined_text", joined("existing_tags").alias("existing_tags"), joined("assigned_labels").alias("assigned_labels"))


@query("W2_small_bounds", FLAT_LABELS)
def w2_small(t: Tables):
    """The same with bounds that every table is beyond: one label per keyword block, no inline values."""
    bounds = {"spark.labelflow.inlineBytes": "100", "spark.labelflow.inlineRows": "1", "spark.labelflow.broadcastBytes": "2000"}
    for k, v in bounds.items():
        t.spark.conf.set(k, v)
    try:
        return w2(t)
    finally:
        for k in bounds:
            t.spark.conf.unset(k)


# -- labels whose names do stand in the texts: the first word of each passage ----------------------

def spoken_labels(t: Tables):
    name = F.regexp_extract("text", r"\p{L}+", 0)
    first = t.benchmark.groupBy(name.alias("label")).agg(F.min(F.struct("item_id", "text")).alias("f"))
    return first.select("label", F.col("f.text").alias("description"), F.col("label").alias("path"), F.col("f.item_id").alias("pos"))


SPOKEN = r"""named AS (SELECT regexp_extract(text, '\p{L}+') AS label, arg_min(text, item_id) AS description, min(item_id) AS pos FROM benchmark GROUP BY 1)"""
PLACED = r"""named AS (SELECT label, path, description, label || ': ' || coalesce(description, 'No description') AS label_text FROM places)"""


def near_sql(k: int, text: str = "combined_text", rows: str = "prepared", first: int | None = None) -> str:
    """CTE ``lists(id, labels, scores)``: the nearest ``k`` of the table ``named`` to each row; with
    ``first``, the best ``k`` of the nearest so many by common words."""
    words = r"list_distinct(regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+'))"
    again = f"""second AS (SELECT n.*, round(CASE WHEN len(list_distinct(list_concat(a, b))) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END, 6) AS share
  FROM near n JOIN (SELECT id AS aid, {words.format(text)} AS a FROM {rows}) x ON x.aid = n.id JOIN (SELECT label AS bl, {words.format('label_text')} AS b FROM named) y ON y.bl = n.label),
best AS (SELECT id, label, score, place AS rank FROM (SELECT id, label, score, row_number() OVER (PARTITION BY id ORDER BY share DESC, score DESC, label) AS place FROM second) WHERE place <= {k})"""
    return f"""{weights_sql(f"(SELECT * FROM {rows} WHERE trim({text}) <> '')", text)}, {embed_sql('vecs', rows, 'id', text)}, {embed_sql('targets', 'named', 'label', 'label_text')},
scored AS (SELECT vecs.key AS id, targets.key AS label,
  coalesce(round(CASE WHEN list_sum(vecs.v) = 0 OR list_sum(targets.v) = 0 THEN 0 ELSE list_cosine_similarity(vecs.v::DOUBLE[], targets.v::DOUBLE[]) END, 6), 0) AS score FROM vecs, targets),
near AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, label) AS rank FROM scored QUALIFY rank <= {first or k}),
{again if first else 'best AS (SELECT id, label, score, rank FROM near)'},
lists AS (SELECT id, list(label ORDER BY rank) AS labels, list(score ORDER BY rank) AS scores FROM best GROUP BY id)"""


def semantic_sql(k: int, first: int | None = None) -> str:
    return rf"""{PREPARED}, {SPOKEN.replace('min(item_id) AS pos FROM', "label || ': ' || description AS label_text, min(item_id) AS pos FROM")}, {near_sql(k, first=first)},
found AS (SELECT id, list_distinct(list_filter(regexp_extract_all(combined_text, '{TOKEN}'), lambda x: regexp_matches(x, '{LOOKS_NAMED}'))) AS e FROM prepared),
known AS (SELECT lower(label) AS low, max(label) AS label FROM named GROUP BY 1),
matched AS (SELECT id, list_sort(list(DISTINCT label)) AS m FROM (SELECT id, lower(unnest(e)) AS low FROM found) JOIN known USING (low) GROUP BY id),
done AS (SELECT id, labels, scores, e, coalesce(m, []) AS m, list_sort(list_distinct(list_concat(labels, coalesce(m, [])))) AS c FROM lists JOIN found USING (id) LEFT JOIN matched USING (id))"""


SEMANTIC_ROWS = """SELECT id, array_to_string(labels, '|') AS ontology_labels_k, round(scores[1], 6) AS best, array_to_string(list_sort(e), '|') AS mentioned_entities,
  array_to_string(m, '|') AS keyword_matched_labels, array_to_string(c, '|') AS combined_ontology_labels FROM done"""


def semantic(t: Tables, **options):
    return P.enrich_semantic(P.prepare(records(t)), spoken_labels(t), 3, dim=DIM, **options)


def semantic_rows(done):
    return done.select("id", joined("ontology_labels_k").alias("ontology_labels_k"), F.round(done["ontology_scores_k"][0], 6).alias("best"),
                       joined(F.array_sort("mentioned_entities")).alias("mentioned_entities"),
                       *[joined(c).alias(c) for c in ("keyword_matched_labels", "combined_ontology_labels")])


@query("W3_enrich_semantic", f"WITH {semantic_sql(3)} {SEMANTIC_ROWS}")
def w3(t: Tables):
    return semantic_rows(semantic(t))


@query("W3_enrich_reranked", f"WITH {semantic_sql(3, 8)} {SEMANTIC_ROWS}")
def w3_reranked(t: Tables):
    return semantic_rows(semantic(t, rerank_from=8))


@query("W3_store_semantic", f"""WITH {semantic_sql(3)}, used AS (SELECT DISTINCT unnest(c) AS label FROM done)
SELECT 'run-1' AS run_id, (SELECT count(*) FROM prepared) AS total_records, (SELECT count(*) FROM used) AS total_unique_labels, 3 AS files""")
def w3_store(t: Tables):
    summary = P.store_semantic(semantic(t), fresh_path(t.spark, "semantic"), "run-1")
    return summary.select("run_id", "total_records", "total_unique_labels", F.size("files_created").alias("files"))


@query("W3_stored_lines", f"WITH {semantic_sql(3)} SELECT id, cleaned_title, array_to_string(labels, '|') AS ontology_labels_k, array_to_string(c, '|') AS combined_ontology_labels FROM done JOIN (SELECT id, cleaned_title FROM prepared) p USING (id)")
def w3_lines(t: Tables):
    path = fresh_path(t.spark, "semantic")
    P.store_semantic(semantic(t), path, "run-1")
    rows = t.spark.read.json(f"{path}/enriched_jsonl")
    return rows.select("id", "cleaned_title", joined("ontology_labels_k").alias("ontology_labels_k"), joined("combined_ontology_labels").alias("combined_ontology_labels"))


@query("W3_stored_statistics", f"""WITH {semantic_sql(3)} SELECT label, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM done), 2) AS percentage
FROM (SELECT unnest(c) AS label FROM done) GROUP BY 1""")
def w3_statistics(t: Tables):
    path = fresh_path(t.spark, "semantic")
    P.store_semantic(semantic(t), path, "run-1")
    rows = t.spark.read.option("header", True).csv(f"{path}/label_statistics")
    return rows.select("label", F.col("count").cast("bigint").alias("count"), F.col("percentage").cast("double").alias("percentage"))


# -- W4: places as labels, so that closure adds nation and region; the reply picks the first two candidates --

def first_two(requests):
    return requests.select("request_id", F.array_join(F.slice("candidate_labels", 1, 2), ", ").alias("reply"), F.lit("ok").alias("status"))


def verified(t: Tables, rounds: int = 3, **options):
    return P.enrich_verified(records(t), places(t), O.without_prompt(first_two), 4, dim=DIM, clusters=6, rounds=rounds, **options)


def verified_sql(first: int | None = None) -> str:
    return rf"""{PREPARED}, {PLACES},
sentences AS (SELECT id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT id, regexp_extract_all(cleaned_content, '[^.!?\n]+[.!?]?') AS l FROM prepared)),
summaries AS (SELECT id, trim(s) AS summary FROM sentences
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY len(list_distinct(regexp_extract_all(lower(s), '[\p{{L}}\p{{N}}]+'))) DESC, i) = 1),
told AS (SELECT p.id::VARCHAR AS id, cleaned_title || ' | Summary: ' || coalesce(summary, '') AS summary_and_title FROM prepared p LEFT JOIN summaries USING (id)),
{PLACED}, {near_sql(4, 'summary_and_title', 'told', first)},
chosen AS (SELECT id, labels, labels[1:2] AS v FROM lists),
closed AS (SELECT id, list_sort(list(DISTINCT label)) AS f FROM (
  SELECT id, unnest(v) AS label FROM chosen
  UNION SELECT c.id, a.label FROM (SELECT id, unnest(v) AS label FROM chosen) c JOIN places o ON o.label = c.label JOIN places a ON starts_with(o.path, a.path || '/')) GROUP BY id)"""


VERIFIED_ROWS = """SELECT id, summary_and_title, array_to_string(labels, '|') AS candidate_labels, array_to_string(v, '|') AS llm_verified_labels,
  array_to_string(f, '|') AS final_ontology_labels FROM told JOIN chosen USING (id) JOIN closed USING (id)"""
LISTS = ("candidate_labels", "llm_verified_labels", "final_ontology_labels")


@query("W4_verified_labels", f"WITH {verified_sql()} {VERIFIED_ROWS}")
def w4_labels(t: Tables):
    done, _ = verified(t, enforce_hierarchy=True, expand=False)
    return done.select("id", "summary_and_title", *[joined(c).alias(c) for c in LISTS])


@query("W4_verified_reranked", f"WITH {verified_sql(9)} {VERIFIED_ROWS}")
def w4_reranked(t: Tables):
    done, _ = verified(t, enforce_hierarchy=True, expand=False, rerank_from=9)
    return done.select("id", "summary_and_title", *[joined(c).alias(c) for c in LISTS])


def clustered_sql(rounds: int) -> str:
    return f"{verified_sql()}, told_vecs AS (SELECT key AS id, v FROM vecs), {kmeans_ctes('told_vecs', 6, rounds)}"


@query("W4_enrich_verified", f"WITH {clustered_sql(3)} SELECT r.*, c AS cluster_id FROM ({VERIFIED_ROWS}) r JOIN assigned USING (id)")
def w4(t: Tables):
    done, _ = verified(t, enforce_hierarchy=True)
    return done.select("id", "cluster_id", "summary_and_title", *[joined(c).alias(c) for c in LISTS])


GAP_MEMBERS = "members AS (SELECT id, summary_and_title AS text, c AS cluster_id, f AS labels FROM told JOIN closed USING (id) JOIN assigned USING (id))"


@query("W4_gap_suggestions", f"""WITH {clustered_sql(AT_REST)}, {samples_sql(10, '. ', GAP_MEMBERS)}
SELECT cluster_id, record_count AS cluster_size, array_to_string({entities_sql('sample_text')}, '|') AS potential_new_entities,
  (SELECT w FROM ranked r WHERE r.cluster_id = s.cluster_id AND rank = 1) || ': frequent word of the cluster' AS thematic_gap_suggestions,
  array_to_string(used, '|') AS assigned_labels_in_cluster, 'ok' AS reply_status FROM samples s""")
def w4_gaps(t: Tables):
    _, gaps = verified(t, enforce_hierarchy=True, rounds=REST)
    lists = ("potential_new_entities", "thematic_gap_suggestions", "assigned_labels_in_cluster")
    return gaps.select("cluster_id", "cluster_size", *[joined(c).alias(c) for c in lists], "reply_status")


@query("W4_close_suppliers", r"""WITH sold AS (SELECT DISTINCT s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT s_name AS id, array_to_string(list_sort([s_name, n_name, r_name]), '|') AS final FROM sold""")
def w4_close(t: Tables):
    named = t.supplier.select(F.col("s_name").alias("id"), F.array("s_name").alias("l"))
    return O.close_hierarchy(named, "id", "l", places(t), "final").select("id", joined("final").alias("final"))


def lengths_sql(c: str) -> str:
    n = f"coalesce(length({c}), 0)"
    return f"""SELECT '{c}_length' AS "column", count(*) AS count, round(avg({n}), 6) AS mean, round(stddev_samp({n}), 6) AS std,
  min({n})::DOUBLE AS min, round(quantile_cont({n}, 0.25), 6) AS q25, round(quantile_cont({n}, 0.5), 6) AS q50,
  round(quantile_cont({n}, 0.75), 6) AS q75, max({n})::DOUBLE AS max FROM records"""


@query("W5_profile_lengths", f"WITH {RECORDS} {lengths_sql('title')} UNION ALL {lengths_sql('content')}")
def w5(t: Tables):
    from .aggregates import rounded

    return rounded(P.profile(records(t)).lengths)


@query("W5_profile_top", f"WITH {RECORDS} SELECT url AS value, count(*) AS count FROM records GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def w5_top(t: Tables):
    return P.profile(records(t), ranked=("url",)).top["url"]


@query("W5_profile_sources", "SELECT source AS value, count(*) AS count FROM documents GROUP BY 1")
def w5_sources(t: Tables):
    return P.profile(records(t), texts=("content",)).values["source"]


EXPANDED = f"""{weights_sql('documents', 'text')}, {embed_sql('vecs', 'documents', 'doc_id', 'text')}, points AS (SELECT key AS id, v FROM vecs), {kmeans_ctes('points', 5, AT_REST)},
{samples_sql(5, ' ', 'members AS (SELECT doc_id AS id, text, c AS cluster_id, [source] AS labels FROM documents JOIN assigned ON id = doc_id)')}, {TERMS}"""


def expanded(t: Tables):
    docs = t.documents.select(F.col("doc_id").alias("id"), "text", F.array("source").alias("labels"))
    return P.expand(docs, "text", "labels", k=5, dim=DIM)


@query("W6_expand_themes", f"""WITH {EXPANDED}
SELECT cluster_id, record_count, (SELECT word FROM told r WHERE r.cluster_id = s.cluster_id AND rank = 1) AS cluster_theme,
  (SELECT string_agg(word, '|' ORDER BY rank) FROM told r WHERE r.cluster_id = s.cluster_id AND rank BETWEEN 2 AND 6) AS subtopics FROM samples s""")
def w6(t: Tables):
    return expanded(t).themes.select("cluster_id", "record_count", "cluster_theme", joined("subtopics").alias("subtopics"))


@query("W6_expand_new_labels", f"WITH {EXPANDED} SELECT DISTINCT word AS label FROM told WHERE rank <= 6 AND word NOT IN (SELECT source FROM documents)")
def w6_new(t: Tables):
    return expanded(t).new_labels


@query("W6_expand_sizes", f"WITH {EXPANDED} SELECT c AS cluster_id, count(*) AS count FROM assigned GROUP BY 1")
def w6_sizes(t: Tables):
    return expanded(t).sizes


# -- a profile from sketches: documents by source, one source stored twice --------------------------------

def stored_sketches(t: Tables):
    path = fresh_path(t.spark, "sketches")
    docs = t.documents.select("source", "doc_id", "lang", "n_chars")
    O.store_sketches(O.sketch_columns(docs, ["doc_id", "lang", "n_chars"], F.col("source")), path)
    again = docs.filter("source = 'src0'")
    O.store_sketches(O.sketch_columns(again, ["doc_id", "lang", "n_chars"], F.col("source")), path)
    return O.read_sketches(t.spark, path)


def _counted(column: str, number: bool) -> str:
    low, high = (f"min({column})::DOUBLE", f"max({column})::DOUBLE") if number else ("NULL::DOUBLE", "NULL::DOUBLE")
    return f"SELECT '{column}' AS \"column\", count(*) AS n, count(*) - count({column}) AS nulls, {low} AS low, {high} AS high FROM documents"


@query("W5_merged_counts", " UNION ALL ".join(_counted(c, c != "lang") for c in ("doc_id", "lang", "n_chars")))
def w5_merged(t: Tables):
    """Exact counts and bounds of the whole table, merged from its parts."""
    return O.merge_sketches(stored_sketches(t)).select("column", "n", "nulls", "low", "high")


@query("W5_merged_top", """
SELECT * FROM (SELECT 'lang' AS "column", lang AS item, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 3)""")
def w5_merged_top(t: Tables):
    """Frequent values of a column with fewer values than are tracked, so the merged counts are exact."""
    merged = O.merge_sketches(stored_sketches(t).filter(F.col("column") == "lang"))
    return O.sketch_summary(merged, top=3).select("column", F.inline("top")).select("column", "item", "count")


@query("W5_merged_profile")
def w5_merged_profile(t: Tables):
    """With estimates: distinct values and quantiles, held against the exact forms in the tests."""
    told = O.sketch_summary(O.merge_sketches(stored_sketches(t)))
    quarters = [F.col("quantiles")[k].alias(f"q{k + 1}") for k in range(3)]
    return told.select("column", "n", "nulls", "n_distinct", *quarters, joined(F.col("top")["item"]).alias("top"))
