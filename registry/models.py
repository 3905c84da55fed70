"""Model-backed operators: requests, replies, extraction, vectors, clusters, gaps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow import operators as O
from labelflow.operators.clusters import GAP_PROMPT
from labelflow.operators.replies import CLASSIFY, VERIFY
from labelflow.operators.skew import join_unique
from labelflow.operators.vectors import UNIT
from labelflow.settings import written

from . import Tables, query
from .derived import NEAREST, PASSAGE_TERMS, REPLIES, joined, passages, phrases, prototypes, replies, vectors
from .matching import KEYWORDS, documents


def template_sql(template: str, **slots: str) -> str:
    """The template as a SQL concatenation."""
    text = "'" + template.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    for name, sql in slots.items():
        text = text.replace("{" + name + "}", f"' || {sql} || '")
    return text


def escaped(c: str) -> str:
    return rf"""replace(replace(replace(replace({c}, '\', '\\'), '"', '\"'), chr(10), ' '), chr(13), '')"""


@query("M1_classification_requests", f"""
WITH block AS (SELECT string_agg((item_id + 1) || '. Passage_' || item_id || ': ' || text, chr(10) ORDER BY item_id) AS b FROM benchmark)
SELECT doc_id AS id, doc_id::VARCHAR AS request_id, md5({template_sql(CLASSIFY, text='text', labels='b', k="'5'")}) AS prompt FROM documents, block""")
def m1(t: Tables):
    asked = O.classification_requests(documents(t), "text", passages(t), 5)
    return asked.select("id", "request_id", F.md5(F.col("prompt").cast("binary")).alias("prompt"))


@query("M1_request_pages", f"""
WITH block AS (SELECT string_agg('Passage_' || item_id || ': ' || text, chr(10) ORDER BY item_id) AS b FROM benchmark)
SELECT doc_id AS id, md5(b) AS labels, md5({template_sql(CLASSIFY, text='text', labels="''", k="'5'")}) AS question FROM documents, block""")
def m1_pages(t: Tables):
    """The label list in pages of 4 KiB: every record is asked about all labels once, in taxonomy order, by the same question."""
    asked = O.classification_requests(documents(t), "text", passages(t), 5, page_bytes=4096)
    parts = r"(?s)^(.*\n\nLabels:\n)(.*)(\n\nAnswer with at most .*)$"
    question = F.concat(F.regexp_extract("prompt", parts, 1), F.regexp_extract("prompt", parts, 3))
    pages = asked.select("id", "page", F.regexp_extract("prompt", parts, 2).alias("numbered"), F.md5(question.cast("binary")).alias("question"))
    # equal lines are gathered once: a record carries their digests, and each different list of digests is put together
    marked = written(pages.withColumn("mark", F.unhex(F.sha2("numbered", 256))), "page_lines")
    lines = F.regexp_replace(F.collect_set("numbered")[0], r"(?m)^\d+\. (?=Passage_\d)", "")
    known = marked.groupBy("mark").agg(lines.alias("lines"))  # combined where it is made; few digests need no sort
    order = F.array_sort(F.collect_list(F.struct("page", "mark")))
    asks = written(marked.groupBy("id", "question").agg(order.alias("l")).select("id", "question", F.transform("l", lambda e: e["mark"]).alias("marks")), "asked_pages")
    lists = asks.groupBy("marks").agg(F.count(F.lit(1)).alias("times"))
    spoken = lists.select("marks", F.posexplode("marks").alias("at", "mark")).join(known, "mark")
    whole = spoken.groupBy("marks").agg(F.array_sort(F.collect_list(F.struct("at", "lines"))).alias("l"))
    text = F.array_join(F.transform("l", lambda e: e["lines"]), "\n")
    put = whole.select("marks", F.md5(text.cast("binary")).alias("labels")).join(lists, "marks")
    return join_unique(asks, put, "marks", "times", asks.count()).select("id", "labels", "question")


@query("M2_parse_reply", f"""WITH {REPLIES}, items AS (
  SELECT id, unnest(l) AS item, generate_subscripts(l, 1) AS i
  FROM (SELECT id, list_transform(string_split(reply, ','), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS l FROM replies)),
valid AS (SELECT id, item, row_number() OVER (PARTITION BY id ORDER BY i) AS rank FROM items JOIN phrases ON item = label)
SELECT replies.id, coalesce(string_agg(item, '|' ORDER BY rank), '') AS labels FROM replies LEFT JOIN valid ON valid.id = replies.id AND rank <= 3 GROUP BY 1""")
def m2(t: Tables):
    read = replies(t).withColumn("items", O.parse_reply("reply"))
    checked = O.validate_labels(read, "id", "items", phrases(t), "valid")
    return checked.select("id", joined(F.slice("valid", 1, 3)).alias("labels"))


def logged(t: Tables):
    """Replies made from the document marks; documents without marks have none."""
    reply = F.when(F.col("toxic") == 1, "None").when(F.col("quality") == 1, "Passage_1, Passage_2,Passage_1, Other").otherwise("no idea")
    return t.labels.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("string").alias("request_id"),
                           reply.alias("reply"), F.lit("ok").alias("status"))


def assigned_sql(fallback: str) -> str:
    return f"""WITH {KEYWORDS}
SELECT k.id, coalesce(CASE WHEN m.doc_id IS NULL OR toxic = 1 {fallback} THEN array_to_string(k.labels, '|')
  WHEN quality = 1 THEN 'Passage_1|Passage_2|Passage_1' ELSE '' END, '') AS labels
FROM labelled k LEFT JOIN labels m ON m.doc_id = k.id"""


@query("M3_fallback_chain", assigned_sql(""))
def m3(t: Tables):
    done = O.assign_by_reply(documents(t), logged(t), "text", passages(t), 5)
    return done.select("id", joined("assigned_labels").alias("labels"))


@query("M3_fallback_on_invalid", assigned_sql("OR quality = 0"))
def m3_invalid(t: Tables):
    done = O.assign_by_reply(documents(t), logged(t), "text", passages(t), 5, fallback_on=("none", "error", "invalid"))
    return done.select("id", joined("assigned_labels").alias("labels"))


@query("M3_empty_on_error", f"""WITH {KEYWORDS}
SELECT k.id, coalesce(CASE WHEN toxic = 1 THEN array_to_string(k.labels, '|') WHEN quality = 1 THEN 'Passage_1|Passage_2|Passage_1' ELSE '' END, '') AS labels
FROM labelled k LEFT JOIN labels m ON m.doc_id = k.id""")
def m3_empty(t: Tables):
    done = O.assign_by_reply(documents(t), logged(t), "text", passages(t), 5, on_error="empty")
    return done.select("id", joined("assigned_labels").alias("labels"))


def logged_again(t: Tables):
    """Every reply logged three times: first failed, then good, then with another text."""
    said = logged(t)
    failed = said.withColumn("reply", F.lit(None).cast("string")).withColumn("status", F.lit("error")).withColumn("attempt", F.lit(1))
    later = said.withColumn("reply", F.lit("Passage_3")).withColumn("attempt", F.lit(3))
    return failed.unionByName(said.withColumn("attempt", F.lit(2))).unionByName(later).repartition(3)


@query("M3_retried_replies", assigned_sql(""))
def m3_retried(t: Tables):
    done = O.assign_by_reply(documents(t), logged_again(t), "text", passages(t), 5)
    return done.select("id", joined("assigned_labels").alias("labels"))


@query("M3_overlap_provider", f"""WITH {PASSAGE_TERMS}, scored AS (
  SELECT doc_id AS id, label, pos, count(DISTINCT term) AS n FROM documents, terms WHERE contains(lower(text), term) GROUP BY ALL)
SELECT id, string_agg(label, ', ' ORDER BY n DESC, pos) AS reply FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, pos) AS rank FROM scored) WHERE rank <= 5 GROUP BY id
UNION ALL SELECT doc_id, 'None' FROM documents WHERE doc_id NOT IN (SELECT id FROM scored)""")
def m3_overlap(t: Tables):
    asked = documents(t).select("id", F.col("id").alias("request_id"), "text")
    return O.overlap_provider(passages(t), 5)(asked).select(F.col("request_id").alias("id"), "reply")


def candidates(t: Tables):
    return O.attach_nearest(vectors(t), prototypes(t), 3).withColumn("text", F.concat(F.lit('say "'), "own", F.lit('"\n')))


CANDIDATES = NEAREST + """, cand AS (
  SELECT n.id, list(n.label ORDER BY rank) AS labels, list(n.description ORDER BY rank) AS notes, any_value(e.own) AS own
  FROM nearest n JOIN (SELECT vec_id AS id, label::VARCHAR AS own FROM embeddings) e ON e.id = n.id WHERE rank <= 3 GROUP BY n.id)"""


SAY = """('say "' || own || '"' || chr(10))"""


@query("M4_verification_requests", f"""WITH {CANDIDATES}
SELECT id, {template_sql(VERIFY, text=escaped(SAY),
    labels="array_to_string(list_transform(labels, lambda x, i: i || '. ' || x || ': ' || notes[i]), chr(10))")} AS prompt FROM cand""")
def m4_requests(t: Tables):
    return O.verification_requests(candidates(t), "text").select("id", "prompt")


@query("M4_verify_candidates", f"""WITH {CANDIDATES}, r AS (SELECT *, ['Class_' || own, 'Class_0', 'Other'] AS said FROM cand)
SELECT id, CASE WHEN own = '1' THEN '' ELSE array_to_string(list_filter(said, lambda x: list_contains(labels, x)), '|') END AS verified,
  CASE WHEN own = '1' THEN '' ELSE array_to_string(list_sort(list_distinct(list_filter(said, lambda x: NOT list_contains(labels, x)))), '|') END AS unknown FROM r""")
def m4(t: Tables):
    reply = F.when(F.col("own") == "1", " none ").otherwise(F.concat(F.lit("Class_"), "own", F.lit(", Class_0 ,Other")))
    said = vectors(t).select(F.col("id").cast("string").alias("request_id"), reply.alias("reply"), F.lit("ok").alias("status"))
    done = O.verify_candidates(candidates(t), said)
    return done.select("id", joined("llm_verified_labels").alias("verified"), joined("unknown_labels").alias("unknown"))


@query("M4_retried_replies", f"""WITH {CANDIDATES}, r AS (SELECT *, ['Class_' || own, 'Class_0'] AS said FROM cand)
SELECT id, array_to_string(list_filter(said, lambda x: list_contains(labels, x)), '|') AS verified FROM r""")
def m4_retried(t: Tables):
    good = F.concat(F.lit("Class_"), "own", F.lit(",Class_0"))
    tries = F.array(F.struct(F.lit(None).cast("string").alias("reply"), F.lit("error").alias("status")), F.struct(good.alias("reply"), F.lit("ok").alias("status")))
    said = vectors(t).select(F.col("id").cast("string").alias("request_id"), F.explode(tries).alias("r")).select("request_id", "r.*")
    return O.verify_candidates(candidates(t), said).select("id", joined("llm_verified_labels").alias("verified"))


@query("M5_extract_fields", """
SELECT doc_id, CASE lang WHEN 'fr' THEN '' ELSE lang || '|' || source END AS entities,
  CASE lang WHEN 'fr' THEN '' WHEN 'de' THEN '' ELSE lang END AS theme, (lang <> 'fr')::INT AS parsed FROM documents""")
def m5(t: Tables):
    theme = F.when(F.col("lang") != "de", F.col("lang"))
    good = F.to_json(F.struct(F.array("lang", "source").alias("entities"), theme.alias("theme")))
    said = t.documents.select("doc_id", F.when(F.col("lang") == "fr", F.concat(F.lit("no JSON: "), "source")).otherwise(good).alias("reply"))
    read = O.extract_fields(said, "entities array<string>, theme string")
    return read.select("doc_id", joined(L.or_empty("entities")).alias("entities"), L.blank_to_empty("theme").alias("theme"),
                       F.col("parsed").cast("int").alias("parsed"))


TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}_.+#-]*[\p{L}\p{N}+#]|\p{L}"
LOOKS_NAMED = r"\p{Lu}|\p{L}[0-9]|\p{L}\.[\p{L}\p{N}]"


def entities_sql(text: str) -> str:
    return f"list_sort(list_distinct(list_filter(regexp_extract_all({text}, '{TOKEN}'), lambda x: regexp_matches(x, '{LOOKS_NAMED}'))))"


@query("M5_mentioned_entities", f"SELECT doc_id, array_to_string({entities_sql('text')}, '|') AS entities FROM documents")
def m5_entities(t: Tables):
    return t.documents.select("doc_id", joined(F.array_sort(O.mentioned_entities("text"))).alias("entities"))


SUMMARY = r"""sentences AS (
  SELECT doc_id, unnest(l) AS s, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]+[.!?]?') AS l FROM documents)),
summaries AS (SELECT doc_id, trim(s) AS summary FROM sentences
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len(list_distinct(regexp_extract_all(lower(s), '[\p{L}\p{N}]+'))) DESC, i) = 1)"""


@query("M6_one_line_summary", f"WITH {SUMMARY} SELECT doc_id, coalesce(summary, '') AS summary FROM documents LEFT JOIN summaries USING (doc_id)")
def m6(t: Tables):
    return t.documents.select("doc_id", O.one_line_summary("text").alias("summary"))


# -- vectors and clusters -------------------------------------------------------------------------

DIM = 64


def buckets_sql(text: str) -> str:
    words = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"
    return f"list_transform({words}, lambda w: ('0x' || substr(md5(w), 1, 8))::BIGINT % {DIM})"


def weights_sql(table: str, text: str) -> str:
    """CTE ``weights(bucket, w)``."""
    return f"""weights AS MATERIALIZED (SELECT bucket, ln(((SELECT count(*) FROM {table}) + 1.0) / (count(*) + 1.0)) AS w
  FROM (SELECT unnest(list_distinct({buckets_sql(text)})) AS bucket FROM {table}) GROUP BY bucket)"""


def embed_sql(name: str, table: str, key: str, text: str) -> str:
    """CTE ``name(key, v)``: unit vectors as lists of FLOAT."""
    return f"""{name}_tf AS (SELECT {key} AS key, bucket, count(*) AS tf FROM (SELECT {key}, unnest({buckets_sql(text)}) AS bucket FROM {table}) GROUP BY ALL),
{name}_x AS (SELECT key, bucket, tf * w AS x FROM {name}_tf JOIN weights USING (bucket)),
{name}_n AS (SELECT key, sqrt(sum(x * x)) AS n FROM {name}_x GROUP BY key),
{name}_grid AS (SELECT k.key, d.bucket, CASE WHEN n > 0 THEN coalesce(x, 0) / n ELSE 0 END AS x
  FROM (SELECT {key} AS key FROM {table}) k CROSS JOIN range({DIM}) d(bucket) LEFT JOIN {name}_n ON {name}_n.key = k.key
    LEFT JOIN {name}_x ON {name}_x.key = k.key AND {name}_x.bucket = d.bucket),
{name} AS MATERIALIZED (SELECT key, list(x::FLOAT ORDER BY bucket) AS v FROM {name}_grid GROUP BY key)"""


@query("M7_bucket_weights", f"WITH {weights_sql('documents', 'text')} SELECT bucket, round(w, 6) AS weight FROM weights")
def m7_weights(t: Tables):
    return O.bucket_weights(documents(t), "text", DIM).select("bucket", F.round("weight", 6).alias("weight"))


@query("M7_embed_text", f"""WITH {weights_sql('documents', 'text')}, {embed_sql('vecs', 'documents', 'doc_id', 'text')}
SELECT key AS id, unnest(range({DIM}))::INT AS bucket, round(unnest(v)::DOUBLE, 5) AS x FROM vecs""")
def m7(t: Tables):
    out = O.embed_text(documents(t), "text", DIM).select("id", F.posexplode("vector").alias("bucket", "x"))
    return out.select("id", "bucket", F.round(F.col("x").cast("double"), 5).alias("x"))


TEXT_NEAREST = f"""WITH {weights_sql('documents', 'text')}, {embed_sql('vecs', 'documents', 'doc_id', 'text')}, {embed_sql('targets', 'benchmark', 'item_id', 'text')},
near AS (SELECT vecs.key AS id, 'Passage_' || targets.key AS label,
    coalesce(round(CASE WHEN list_sum(vecs.v) = 0 OR list_sum(targets.v) = 0 THEN 0 ELSE list_cosine_similarity(vecs.v::DOUBLE[], targets.v::DOUBLE[]) END, 6), 0) AS score FROM vecs, targets)
SELECT id, label, score, (row_number() OVER (PARTITION BY id ORDER BY score DESC, label))::INT AS rank FROM near QUALIFY rank <= 5"""


@query("M7_J1_text_to_labels", TEXT_NEAREST)
def m7_j1(t: Tables):
    docs = documents(t)
    weights = O.weight_vector(docs, "text", DIM)
    targets = O.embed_text(passages(t), "description", DIM, weights=weights)
    return O.nearest_labels(O.embed_text(docs, "text", DIM, weights=weights), targets, 5).select("id", "label", "score", "rank")


def kmeans_ctes(source: str, k: int, rounds: int) -> str:
    """K-means in whole numbers over the table ``source(id, v)``, one CTE per round; the last one,
    ``assigned(id, c)``, has the clusters."""
    ctes = [
        f"""pts AS MATERIALIZED (SELECT id, generate_subscripts(v, 1) AS d, round_even(unnest(v)::DOUBLE * 65536, 0) AS x FROM {source})""",
        f"""c0 AS MATERIALIZED (SELECT c, d, x FROM (SELECT id AS first, row_number() OVER (ORDER BY md5(id || ':42'), id) - 1 AS c FROM {source}) s
  JOIN pts ON id = first WHERE c < {k})""",
    ]
    for i in range(rounds + 1):
        name = "assigned" if i == rounds else f"a{i}"
        ctes.append(f"""{name} AS MATERIALIZED (SELECT id, c::INT AS c FROM (
  SELECT p.id, m.c, sum(m.x * m.x - 2 * p.x * m.x) AS far FROM pts p JOIN c{i} m USING (d) GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY far, c) = 1)""")
        if i < rounds:
            ctes.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce(n.x, o.x) AS x FROM c{i} o
  LEFT JOIN (SELECT c, d, floor(sum(x) / count(*) + 0.5) AS x FROM a{i} JOIN pts USING (id) GROUP BY ALL) n USING (c, d))""")
    return ",\n".join(ctes)


def kmeans_sql(k: int, rounds: int) -> str:
    return f"""WITH points AS (SELECT vec_id AS id, embedding AS v FROM embeddings), {kmeans_ctes('points', k, rounds)}
SELECT id, c AS cluster_id FROM assigned"""


@query("M9_cluster_vectors", kmeans_sql(8, 3))
def m9(t: Tables):
    return O.cluster_vectors(vectors(t), "id", "vector", 8, iterations=3).select("id", "cluster_id")


AT_REST = 30  # rounds of the SQL; at sf0.01 the centres rest after 10 to 23


@query("M9_clusters_at_rest", kmeans_sql(8, AT_REST).replace("c AS cluster_id FROM assigned", "c AS cluster_id, true AS converged FROM assigned"))
def m9_rest(t: Tables):
    found = O.fit_clusters(vectors(t), "id", "vector", 8)
    return found.rows.select("id", "cluster_id", F.lit(found.converged).alias("converged"))


GIVEN = f"""WITH points AS (SELECT vec_id AS id, embedding AS v FROM embeddings), {kmeans_ctes('points', 10, AT_REST)}
SELECT id, c AS cluster_id FROM assigned""".replace(
    "SELECT id AS first, row_number() OVER (ORDER BY md5(id || ':42'), id) - 1 AS c FROM points",
    "SELECT min(vec_id) AS first, row_number() OVER (ORDER BY min(vec_id)) - 1 AS c FROM embeddings GROUP BY label")


@query("M9_from_given_centres", GIVEN)
def m9_given(t: Tables):
    """The first vector of each class as centres to start from."""
    firsts = vectors(t).groupBy("own").agg(F.min(F.struct("id", "vector")).alias("f")).orderBy("f.id").collect()  # a row per class
    start = np.rint(np.array([r["f"]["vector"] for r in firsts]) * UNIT)
    return O.fit_clusters(vectors(t), "id", "vector", len(start), start=start).rows.select("id", "cluster_id")


@query("M9_seeded_clusters")
def m9_seeded(t: Tables):
    found = O.fit_clusters(vectors(t), "id", "vector", 8, start="parallel")
    return found.rows.select("id", "cluster_id", F.lit(found.rounds).alias("rounds"), F.lit(found.converged).alias("converged"))


@query("M9_cluster_ml")
def m9_ml(t: Tables):
    """Which cluster a row gets depends on the partitioning, so there is no SQL; the tests compare it with the fitted centres."""
    return O.cluster_ml(vectors(t), "vector", 8).select("id", "cluster_id")


def clustered(t: Tables):
    """Documents with their source as cluster."""
    return t.documents.select(F.col("doc_id").alias("id"), "text", F.regexp_extract("source", r"\d+", 0).cast("int").alias("cluster_id"),
                              F.array("lang").alias("labels"))


MEMBERS = "members AS (SELECT doc_id AS id, text, regexp_extract(source, '\\d+')::INT AS cluster_id, [lang] AS labels FROM documents)"


def samples_sql(n: int, separator: str, members: str = MEMBERS) -> str:
    return f"""{members},
drawn AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5(id || ':42'), id) AS rank FROM members),
in_use AS (SELECT cluster_id, list_sort(list(DISTINCT label)) AS used FROM (SELECT cluster_id, unnest(labels) AS label FROM members) GROUP BY cluster_id),
samples AS (SELECT s.*, coalesce(used, []) AS used FROM (
  SELECT cluster_id, string_agg(text, '{separator}' ORDER BY rank) FILTER (rank <= {n}) AS sample_text, count(*) AS record_count FROM drawn GROUP BY cluster_id) s
  LEFT JOIN in_use USING (cluster_id)),
spoken AS (SELECT cluster_id, unnest(regexp_extract_all(lower(sample_text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM samples),
ranked AS (SELECT cluster_id, w, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, w) AS rank FROM spoken GROUP BY cluster_id, w)"""


TERMS = r"""said AS (SELECT cluster_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM members),
counted AS (SELECT cluster_id, word, count(*) AS n FROM said GROUP BY ALL),
cluster_words AS (SELECT cluster_id, sum(n) AS size FROM counted GROUP BY 1),
overall AS (SELECT word, sum(n) AS f FROM counted GROUP BY 1),
terms AS (SELECT cluster_id, word, n AS count, round(n / size * ln(1 + (SELECT avg(size) FROM cluster_words) / f), 9) AS score
  FROM counted JOIN cluster_words USING (cluster_id) JOIN overall USING (word)),
told AS (SELECT *, (row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, word))::INT AS rank FROM terms)"""


@query("M10_cluster_terms", f"WITH {MEMBERS}, {TERMS} SELECT cluster_id, word, count, score, rank FROM told WHERE rank <= 10")
def m10_terms(t: Tables):
    return O.cluster_terms(clustered(t), "text", 10)


@query("M10_cluster_themes", f"""WITH {samples_sql(5, ' ')}, {TERMS}
SELECT cluster_id, md5(sample_text) AS sample, record_count, (SELECT word FROM told r WHERE r.cluster_id = s.cluster_id AND rank = 1) AS theme,
  (SELECT string_agg(word, '|' ORDER BY rank) FROM told r WHERE r.cluster_id = s.cluster_id AND rank BETWEEN 2 AND 6) AS subtopics FROM samples s""")
def m10_themes(t: Tables):
    themes = O.cluster_themes(clustered(t), "text")
    return themes.select("cluster_id", F.md5(F.col("sample_text").cast("binary")).alias("sample"), "record_count",
                         F.col("cluster_theme").alias("theme"), joined("subtopics").alias("subtopics"))


@query("M10_themes_by_reply", f"""WITH {samples_sql(5, ' ')}
SELECT cluster_id, md5(sample_text) AS sample, record_count, (SELECT w FROM ranked r WHERE r.cluster_id = s.cluster_id AND rank = 1) AS theme,
  (SELECT string_agg(w, '|' ORDER BY rank) FROM ranked r WHERE r.cluster_id = s.cluster_id AND rank BETWEEN 2 AND 6) AS subtopics FROM samples s""")
def m10(t: Tables):
    themes = O.cluster_themes(clustered(t), "text", provider=O.theme_reply())
    return themes.select("cluster_id", F.md5(F.col("sample_text").cast("binary")).alias("sample"), "record_count",
                         F.col("cluster_theme").alias("theme"), joined("subtopics").alias("subtopics"))


@query("M11_gap_requests", f"""WITH {samples_sql(10, '. ')}
SELECT cluster_id, record_count AS cluster_size, array_to_string(used, '|') AS labels,
  md5({template_sql(GAP_PROMPT, labels="array_to_string(used, ', ')", text=escaped('sample_text'))}) AS prompt FROM samples""")
def m11_requests(t: Tables):
    asked = O.gap_requests(clustered(t), "text", "labels")
    return asked.select("cluster_id", "cluster_size", joined("assigned_labels_in_cluster").alias("labels"),
                        F.md5(F.col("prompt").cast("binary")).alias("prompt"))


@query("M11_missing_replies", f"""WITH {samples_sql(10, '. ')}
SELECT cluster_id, record_count AS cluster_size, CASE cluster_id % 4 WHEN 0 THEN 'Foo|Bar' WHEN 1 THEN 'Foo|Bar' ELSE '' END AS entities,
  CASE cluster_id % 4 WHEN 0 THEN 'a: b|c' WHEN 1 THEN 'a: b' ELSE '' END AS themes,
  CASE cluster_id % 4 WHEN 2 THEN 'unreadable' WHEN 3 THEN 'missing' ELSE 'ok' END AS reply_status FROM samples""")
def m11_missing(t: Tables):
    asked = O.gap_requests(clustered(t), "text", "labels")
    kind = F.col("cluster_id") % 4
    lists = F.lit('{"potential_new_entities": ["Foo", " Bar ", "NONE"], "thematic_gap_suggestions": ["a: b", "c", ""]}')
    texts = F.lit('{"potential_new_entities": "Foo, Bar", "thematic_gap_suggestions": "a: b"}')
    reply = F.when(kind == 0, lists).when(kind == 1, texts).otherwise("1. Foo, Bar")
    said = asked.filter(kind != 3).select("request_id", reply.alias("reply"), F.lit("ok").alias("status"))
    found = O.gap_suggestions(asked, said)
    return found.select("cluster_id", "cluster_size", joined("potential_new_entities").alias("entities"), joined("thematic_gap_suggestions").alias("themes"), "reply_status")


@query("M11_gap_suggestions", f"""WITH {samples_sql(10, '. ')}
SELECT cluster_id, record_count AS cluster_size, array_to_string({entities_sql('sample_text')}, '|') AS potential_new_entities,
  (SELECT w FROM ranked r WHERE r.cluster_id = s.cluster_id AND rank = 1) || ': frequent word of the cluster' AS thematic_gap_suggestions,
  array_to_string(used, '|') AS assigned_labels_in_cluster FROM samples s""")
def m11(t: Tables):
    asked = O.gap_requests(clustered(t), "text", "labels")
    found = O.gap_suggestions(asked, O.pattern_gaps()(asked))
    lists = ("potential_new_entities", "thematic_gap_suggestions", "assigned_labels_in_cluster")
    return found.select("cluster_id", "cluster_size", *[joined(c).alias(c) for c in lists])


HARVEST = f"""harvest AS (SELECT doc_id, unnest({entities_sql('text')}) AS item FROM (
  SELECT * FROM documents ORDER BY md5(doc_id || ':42'), doc_id LIMIT 20))"""


@query("M12_entity_harvest", f"WITH {HARVEST} SELECT item, count(*) AS count FROM harvest GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def m12(t: Tables):
    return O.entity_harvest(documents(t), "text")[1]


@query("M12_entity_categories", f"""WITH {HARVEST}
SELECT CASE WHEN regexp_matches(item, '^\\p{{Lu}}{{2,}}$') THEN 'acronym' WHEN regexp_matches(item, '^\\p{{Lu}}\\p{{Ll}}*$') THEN 'name' ELSE 'mixed' END AS category,
  count(*) AS count FROM harvest GROUP BY 1""")
def m12_categories(t: Tables):
    return O.entity_harvest(documents(t), "text")[2]


@query("M13_reply_text", "SELECT conv_id, turn, text AS reply FROM conversations")
def m13(t: Tables):
    plain = F.struct(F.col("text").alias("text"))
    nested = F.struct(F.struct(F.col("text").alias("content")).alias("message"))
    envelope = (
        F.when(F.col("role") == "assistant", F.to_json(F.struct(F.array(plain).alias("choices"))))
        .when(F.col("role") == "system", F.to_json(F.struct(F.array(nested).alias("choices")))).otherwise(F.col("text"))
    )
    return t.conversations.select("conv_id", "turn", O.reply_text(envelope).alias("reply"))


@query("M13_other_objects", "SELECT event_id, props AS reply FROM events")
def m13_props(t: Tables):
    return t.events.select("event_id", O.reply_text("props").alias("reply"))
