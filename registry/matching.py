"""Joins of records and labels, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow import operators as O
from labelflow import sources as S
from labelflow.settings import fresh_path, spread

from . import Tables, query
from .derived import (
    NEAREST, ORDER_LABELS, PASSAGE_TERMS, PLACES, REPLIES, joined, order_labels, passages, phrases, places, prototypes,
    replies, vectors,
)


def documents(t: Tables):
    return spread(t.documents.select(F.col("doc_id").alias("id"), "text", "lang", "source"))


# -- J1: similarity -------------------------------------------------------------------------------

TOP_3 = f"WITH {NEAREST} SELECT id, label, path, description, score, rank::INT AS rank FROM nearest WHERE rank <= 3"


@query("J1_nearest_labels", TOP_3)
def j1(t: Tables):
    return O.nearest_labels(vectors(t), prototypes(t), 3)


@query("J1_nearest_labels_grid", TOP_3)
def j1_grid(t: Tables):
    return O.nearest_labels(vectors(t), prototypes(t), 3, form="grid")


@query("J1_nearest_labels_cells", TOP_3)
def j1_cells(t: Tables):
    return O.nearest_labels(vectors(t), prototypes(t), 3, form="cells")


def vector_index(t: Tables, buckets: int | None = None):
    """All vectors as labels in a stored index: the labels and their cells."""
    path = fresh_path(t.spark, "index")
    names = vectors(t).select(F.col("id").alias("key"), "vector", F.concat(F.lit("Vector_"), F.col("id").cast("string")).alias("label"))
    S.write_index(names, path, "key", buckets=buckets, keep=("label",))
    return S.read_index(t.spark, path), O.as_cells(S.read_cells(t.spark, path))


ALL_NEAREST = """scores AS (SELECT a.vec_id AS id, 'Vector_' || b.vec_id AS name, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
  FROM embeddings a, embeddings b),
near AS (SELECT id, name AS label, score FROM scores QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, name) <= 5)"""


@query("S11_J1_stored_index", f"WITH {ALL_NEAREST} SELECT id, string_agg(label, '|' ORDER BY score DESC, label) AS labels, min(score) AS worst FROM near GROUP BY id")
def j1_stored(t: Tables):
    labels, cells = vector_index(t)
    near = O.attach_nearest(vectors(t), labels, 5, form="cells", cells=cells)
    return near.select("id", joined("candidate_labels").alias("labels"), F.array_min("candidate_scores").alias("worst"))


WORDS = r"""spoken AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM spoken GROUP BY 1),
shares AS (SELECT a.doc_id AS id, b.doc_id AS other, count(*) AS common FROM spoken a JOIN spoken b USING (w) GROUP BY ALL),
scored AS (SELECT id, 'Text_' || other AS label, round(common / (x.n + y.n - common), 6) AS score
  FROM shares JOIN sizes x ON x.doc_id = id JOIN sizes y ON y.doc_id = other)"""


def word_matches_sql(threshold: float, k: int) -> str:
    return f"""WITH {WORDS} SELECT id, label, score, (row_number() OVER (PARTITION BY id ORDER BY score DESC, label))::INT AS rank
FROM scored WHERE score >= {threshold} QUALIFY rank <= {k}"""


for _t, _k in ((0.8, 3), (0.4, 5)):

    @query(f"J1_word_matches_{int(10 * _t)}", word_matches_sql(_t, _k))
    def j1_words(t: Tables, threshold=_t, k=_k):
        texts = documents(t)
        named = texts.select(F.concat(F.lit("Text_"), F.col("id").cast("string")).alias("label"), "text")
        return O.word_matches(texts, named, k, threshold, label_text="text").drop("path")


@query("J1_more_than_all_labels", f"WITH {NEAREST} SELECT id, count(*) AS n, min(score) AS worst FROM nearest GROUP BY id")
def j1_all(t: Tables):
    near = O.nearest_labels(vectors(t), prototypes(t), 1000)
    return near.groupBy("id").agg(F.count("*").alias("n"), F.min("score").alias("worst"))


LISTS = f"""WITH {NEAREST}
SELECT id, array_to_string(list(label ORDER BY rank), '|') AS candidate_labels, array_to_string(list(path ORDER BY rank), '|') AS candidate_paths,
  max(score) AS best FROM nearest WHERE rank <= 3 GROUP BY id"""


@query("J1_A1_J2_attached_lists", LISTS)
def j1_lists(t: Tables):
    near = O.attach_nearest(vectors(t), prototypes(t), 3)
    return near.select("id", joined("candidate_labels").alias("candidate_labels"), joined("candidate_paths").alias("candidate_paths"),
                       F.array_max("candidate_scores").alias("best"))


@query("A1_ranked_lists", LISTS)
def a1(t: Tables):
    near = O.nearest_labels(vectors(t), prototypes(t), 3)
    lists = O.ranked_lists(near, "id", {"candidate_labels": "label", "candidate_paths": "path", "s": "score"})
    return lists.select("id", joined("candidate_labels").alias("candidate_labels"), joined("candidate_paths").alias("candidate_paths"),
                        F.array_max("s").alias("best"))


@query("J2_merge_lists", """
SELECT doc_id, coalesce(quality::VARCHAR, '') AS marks FROM documents LEFT JOIN labels USING (doc_id)""")
def j2(t: Tables):
    lists = t.labels.select("doc_id", F.array(F.col("quality").cast("string")).alias("marks"))
    return O.merge_on_id(t.documents.select("doc_id"), lists, "doc_id").select("doc_id", joined("marks").alias("marks"))


@query("M8_rerank", f"""WITH {NEAREST}, second AS (
  SELECT id, label, score, round(abs(score - 0.1), 6) AS second_score FROM nearest WHERE rank <= 6)
SELECT id, label, score, second_score, (row_number() OVER (PARTITION BY id ORDER BY second_score DESC, score DESC, label))::INT AS rank
FROM second QUALIFY rank <= 2""")
def m8(t: Tables):
    first = O.nearest_labels(vectors(t), prototypes(t), 6)
    best = O.rerank(first, "id", F.abs(F.col("score") - 0.1), 2)
    return best.select("id", "label", "score", "second_score", "rank")


@query("M8_token_jaccard", r"""
WITH b AS (SELECT item_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS w FROM benchmark),
pairs AS (SELECT a.item_id AS a, c.item_id AS b, a.w AS x, c.w AS y FROM b a JOIN b c ON c.item_id = a.item_id + 1)
SELECT a, b, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))), 6) AS jaccard FROM pairs""")
def m8_jaccard(t: Tables):
    b = t.benchmark
    nxt = b.select((F.col("item_id") - 1).alias("a"), F.col("item_id").alias("b"), F.col("text").alias("other"))
    return b.join(nxt, b["item_id"] == nxt["a"]).select("a", "b", F.round(O.token_jaccard("text", "other"), 6).alias("jaccard"))


# -- J3, J6, J7, J8: lookups in lists -------------------------------------------------------------

@query("J3_match_entities", """
WITH known AS (SELECT DISTINCT n_name FROM nation)
SELECT o_orderkey AS id, CASE WHEN n_name IS NULL THEN '' ELSE n_name END AS found
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def j3(t: Tables):
    who = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    said = who.select(F.col("o_orderkey").alias("id"), F.array(F.lower("n_name"), F.initcap("n_name"), F.col("c_mktsegment")).alias("entities"))
    return O.match_entities(said, "id", "entities", t.nation.select(F.col("n_name").alias("label")), "found").select("id", joined("found").alias("found"))


J3_JOIN = f"""WITH {ORDER_LABELS}
SELECT id, array_to_string(list_sort(list_filter(labels, lambda x: starts_with(x, 'Supplier'))), '|') AS found FROM order_labels"""


@query("J3_match_entities_join", J3_JOIN)
def j3_join(t: Tables):
    said = order_labels(t).select("id", F.transform("labels", F.upper).alias("entities"))
    names = t.supplier.select(F.col("s_name").alias("label"))
    return O.match_entities(said, "id", "entities", names, "found", form="join").select("id", joined("found").alias("found"))


@query("J4_update_by_key", """
SELECT doc_id, CASE WHEN quality = 1 THEN 7 ELSE -1 END AS cluster_id FROM documents LEFT JOIN labels USING (doc_id)""")
def j4(t: Tables):
    base = t.documents.select("doc_id", F.lit(-1).alias("cluster_id"))
    new = t.labels.select("doc_id", F.when(F.col("quality") == 1, 7).alias("cluster_id"))
    return O.update_by_key(base, new, "doc_id", "cluster_id", default=-1)


@query("J9_map_back", "SELECT doc_id, coalesce(quality::VARCHAR, '') AS note FROM documents LEFT JOIN labels USING (doc_id)")
def j9(t: Tables):
    sent = t.labels.select("doc_id", F.col("quality").cast("string").alias("note"))
    return O.update_by_key(t.documents.select("doc_id"), sent, "doc_id", "note", default="")


KEYWORDS = f"""{PASSAGE_TERMS}, hits AS (
  SELECT DISTINCT doc_id AS id, pos, label FROM documents, terms WHERE contains(lower(text), term)),
top AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY id ORDER BY pos) <= 5),
labelled AS (SELECT doc_id AS id, list(label ORDER BY pos) FILTER (label IS NOT NULL) AS labels
  FROM documents LEFT JOIN top ON top.id = doc_id GROUP BY doc_id)"""
KEYWORD_LABELS = f"WITH {KEYWORDS} SELECT id, coalesce(array_to_string(labels, '|'), '') AS labels FROM labelled"


@query("J5_keyword_match", KEYWORD_LABELS)
def j5(t: Tables):
    return O.match_keywords(documents(t), "text", passages(t), 5).select("id", joined("labels").alias("labels"))


@query("J5_keyword_match_inline", KEYWORD_LABELS)
def j5_inline(t: Tables):
    return O.match_keywords(documents(t), "text", passages(t), 5, form="inline").select("id", joined("labels").alias("labels"))


@query("J5_keyword_match_automaton", KEYWORD_LABELS)
def j5_automaton(t: Tables):
    return O.match_keywords(documents(t), "text", passages(t), 5, form="automaton").select("id", joined("labels").alias("labels"))


@query("J5_keyword_match_shuffled", KEYWORD_LABELS)
def j5_shuffled(t: Tables):
    return O.match_keywords(documents(t), "text", passages(t), 5, form="blocks").select("id", joined("labels").alias("labels"))


@query("J5_whole_words", r"""
WITH names AS (SELECT p_name AS label, min(p_partkey) AS pos FROM part GROUP BY 1),
terms AS (SELECT label, pos, unnest(string_split(label, ' ')) AS term FROM names),
hits AS (SELECT DISTINCT doc_id, label, pos FROM documents, terms
  WHERE contains(' ' || regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g') || ' ', ' ' || term || ' ')),
top AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY pos) <= 3)
SELECT documents.doc_id AS id, coalesce(array_to_string(list(label ORDER BY pos) FILTER (label IS NOT NULL), '|'), '') AS labels
FROM documents LEFT JOIN top ON top.doc_id = documents.doc_id GROUP BY 1""")
def j5_words(t: Tables):
    names = t.part.groupBy(F.col("p_name").alias("label")).agg(F.min("p_partkey").alias("pos")).withColumn("description", F.lit(""))
    return O.match_keywords(documents(t), "text", names, 3, word_match=True).select("id", joined("labels").alias("labels"))


SAID = REPLIES + r""", lists AS (
  SELECT id, list_filter(list_transform(string_split(reply, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS l FROM replies),
said AS (SELECT id, unnest(l) AS item, generate_subscripts(l, 1) AS i FROM lists),
known AS (SELECT said.*, label IS NOT NULL AS ok FROM said LEFT JOIN phrases ON label = item)"""


@query("J6_validate_labels", f"""WITH {SAID}
SELECT replies.id, coalesce(string_agg(item, '|' ORDER BY i) FILTER (ok), '') AS valid FROM replies LEFT JOIN known ON known.id = replies.id GROUP BY 1""")
def j6(t: Tables):
    said = replies(t).withColumn("items", L.split_items("reply"))
    return O.validate_labels(said, "id", "items", phrases(t), "valid").select("id", joined("valid").alias("valid"))


@query("J6_valid_items_in_row", f"""WITH {ORDER_LABELS}
SELECT id, array_to_string(list_filter(labels, lambda x: starts_with(x, 'Supplier')), '|') AS valid, labels[len(labels)] AS invalid FROM order_labels""")
def j6_row(t: Tables):
    o = order_labels(t).withColumn("allowed", F.filter("labels", lambda x: x.startswith("Supplier")))
    return o.select("id", joined(O.valid_items("labels", "allowed")).alias("valid"), joined(O.invalid_items("labels", "allowed")).alias("invalid"))


@query("J7_U4_unknown_labels", f"""WITH {SAID}
SELECT replies.id, coalesce(array_to_string(list_sort(list(DISTINCT item) FILTER (NOT ok)), '|'), '') AS unknown FROM replies LEFT JOIN known ON known.id = replies.id GROUP BY 1""")
def j7(t: Tables):
    said = replies(t).withColumn("items", L.split_items("reply"))
    return O.unknown_labels(said, "id", "items", phrases(t), "unknown").select("id", joined("unknown").alias("unknown"))


CLOSED = f"""WITH {ORDER_LABELS}, {PLACES}, items AS (SELECT id, unnest(labels) AS label FROM order_labels),
closed AS (SELECT id, label FROM items
  UNION SELECT i.id, a.label FROM items i JOIN places c ON c.label = i.label JOIN places a ON starts_with(c.path, a.path || '/'))
SELECT id, array_to_string(list_sort(list(label)), '|') AS closed FROM closed GROUP BY id"""


@query("J8_hierarchy_closure", CLOSED)
def j8(t: Tables):
    return O.close_hierarchy(order_labels(t), "id", "labels", places(t), "closed").select("id", joined("closed").alias("closed"))


@query("J8_hierarchy_closure_join", CLOSED)
def j8_join(t: Tables):
    return O.close_hierarchy(order_labels(t), "id", "labels", places(t), "closed", form="join").select("id", joined("closed").alias("closed"))


@query("J8_hierarchy_closure_inline", CLOSED)
def j8_inline(t: Tables):
    return O.close_hierarchy(order_labels(t), "id", "labels", places(t), "closed", form="inline").select("id", joined("closed").alias("closed"))


@query("J8_closure_off", f"WITH {ORDER_LABELS} SELECT id, array_to_string(labels, '|') AS closed FROM order_labels")
def j8_off(t: Tables):
    return O.close_hierarchy(order_labels(t), "id", "labels", places(t), "closed", enabled=False).select("id", joined("closed").alias("closed"))


# -- one answer whatever the size: ids that repeat or are NULL, in every form ----------------------

ODD_ID = "CASE WHEN {0} % 3 > 0 THEN {0} % 5 END"


def odd_id(c: str):
    return F.when(F.col(c) % 3 > 0, F.col(c) % 5)


for _form in ("inline", "broadcast", "join"):

    @query(f"J3_odd_ids_{_form}", f"""WITH {ORDER_LABELS}
SELECT {ODD_ID.format('id')} AS id, id AS o, array_to_string(list_sort(list_filter(labels, lambda x: starts_with(x, 'Supplier'))), '|') AS found FROM order_labels""")
    def j3_odd(t: Tables, form=_form):
        rows = order_labels(t).select(odd_id("id").alias("id"), F.col("id").alias("o"), F.transform("labels", F.upper).alias("said"))
        names = t.supplier.select(F.col("s_name").alias("label"))
        return O.match_entities(rows, "id", "said", names, "found", form=form).select("id", "o", joined("found").alias("found"))

    @query(f"J6_J7_odd_ids_{_form}", f"""WITH {ORDER_LABELS}
SELECT {ODD_ID.format('id')} AS id, id AS o, array_to_string(list_filter(labels, lambda x: starts_with(x, 'Supplier')), '|') AS valid, labels[len(labels)] AS unknown FROM order_labels""")
    def j6_odd(t: Tables, form=_form):
        rows = order_labels(t).select(odd_id("id").alias("id"), F.col("id").alias("o"), "labels")
        names = t.supplier.select(F.col("s_name").alias("label"))
        checked = O.validate_labels(rows, "id", "labels", names, "valid", form=form)
        done = O.unknown_labels(checked, "id", "labels", names, "unknown", form=form)
        return done.select("id", "o", joined("valid").alias("valid"), joined("unknown").alias("unknown"))

    @query(f"J8_odd_ids_{_form}", f"SELECT {ODD_ID.format('id')} AS id, id AS o, closed FROM ({CLOSED})")
    def j8_odd(t: Tables, form=_form):
        rows = order_labels(t).select(odd_id("id").alias("id"), F.col("id").alias("o"), "labels")
        return O.close_hierarchy(rows, "id", "labels", places(t), "closed", form=form).select("id", "o", joined("closed").alias("closed"))


for _form in ("inline", "automaton", "blocks"):

    @query(f"J5_odd_ids_{_form}", f"SELECT {ODD_ID.format('id')} AS id, id AS o, labels FROM ({KEYWORD_LABELS})")
    def j5_odd(t: Tables, form=_form):
        rows = documents(t).select(odd_id("id").alias("id"), F.col("id").alias("o"), "text")
        return O.match_keywords(rows, "text", passages(t), 5, form=form).select("id", "o", joined("labels").alias("labels"))


for _form in ("broadcast", "grid"):

    @query(f"J1_odd_ids_{_form}", f"""WITH {NEAREST}
SELECT {ODD_ID.format('id')} AS id, id AS o, array_to_string(list(label ORDER BY rank), '|') AS labels FROM nearest WHERE rank <= 3 GROUP BY nearest.id""")
    def j1_odd(t: Tables, form=_form):
        rows = vectors(t).select(odd_id("id").alias("id"), F.col("id").alias("o"), "vector")
        return O.attach_nearest(rows, prototypes(t), 3, form=form).select("id", "o", joined("candidate_labels").alias("labels"))


# -- J3: names that differ by a letter or two -------------------------------------------------------

# the SQL engine counts bytes, so letters beyond ASCII become capitals, which the lower-case words don't have
ACCENTS, CAPITALS = "áàâäãåçéèêëíìîïñóòôöõúùûüß", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
assert len(ACCENTS) == len(CAPITALS)


def edits_sql(a: str, b: str) -> str:
    return "levenshtein({}, {})".format(*(f"translate({c}, '{ACCENTS}', '{CAPITALS}')" for c in (a, b)))


EDITS = edits_sql("name", "target")
NAMES = r"""names AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS name FROM conversations),
targets AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS target FROM benchmark)"""


def spoken_names(t: Tables):
    names = t.conversations.select(F.explode(L.words("text")).alias("name"))
    return names, t.benchmark.select(F.explode(L.words("text")).alias("target"))


for _d in (1, 2):

    @query(f"J3_fuzzy_pairs_{_d}", f"WITH {NAMES} SELECT name, target, {EDITS}::INT AS distance FROM names, targets WHERE abs(length(name) - length(target)) <= {_d} AND {EDITS} <= {_d}")
    def j3_fuzzy(t: Tables, distance=_d):
        return O.fuzzy_pairs(*spoken_names(t), distance)


@query("J3_fuzzy_entities", f"""WITH {NAMES}, said AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS name FROM conversations),
near AS (SELECT name, target FROM names, targets WHERE abs(length(name) - length(target)) <= 1 AND {EDITS} <= 1
  QUALIFY {EDITS} = min({EDITS}) OVER (PARTITION BY name))
SELECT c.conv_id, c.turn, coalesce(array_to_string(list_sort(list(DISTINCT target) FILTER (target IS NOT NULL)), '|'), '') AS found
FROM conversations c LEFT JOIN said USING (conv_id, turn) LEFT JOIN near USING (name) GROUP BY ALL""")
def j3_fuzzy_entities(t: Tables):
    rows = t.conversations.select("conv_id", "turn", L.words("text").alias("entities"))
    labels = t.benchmark.select(F.explode(L.words("text")).alias("label"))
    found = O.match_entities_fuzzy(rows, "entities", labels, "found")
    return found.select("conv_id", "turn", joined("found").alias("found"))


# -- set operations -------------------------------------------------------------------------------

@query("U1_union", "SELECT r_name AS label, 'region' AS kind FROM region UNION ALL SELECT n_name, 'nation' FROM nation UNION ALL SELECT s_name, 'supplier' FROM supplier")
def u1(t: Tables):
    a = t.region.select(F.col("r_name").alias("label"), F.lit("region").alias("kind"))
    b = t.nation.select(F.lit("nation").alias("kind"), F.col("n_name").alias("label"))
    c = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("label"))
    return a.unionByName(b).unionByName(c)


@query("U2_combine_lists", f"""WITH {ORDER_LABELS}
SELECT o_orderkey AS o, array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), [o_orderstatus, o_orderpriority]))), '|') AS combined
FROM orders LEFT JOIN order_labels ON id = o_orderkey""")
def u2(t: Tables):
    both = t.orders.join(order_labels(t), F.col("o_orderkey") == F.col("id"), "left")
    return both.select(F.col("o_orderkey").alias("o"), joined(O.combine_lists("labels", F.array("o_orderstatus", "o_orderpriority"))).alias("combined"))


@query("U3_new_label_candidates", f"""WITH {REPLIES}
SELECT DISTINCT label FROM (SELECT unnest(list_concat([string_split(text, ' ')[1]], string_split(text, ' '))) AS label FROM benchmark)
WHERE label NOT IN (SELECT unnest(string_split(text, ' ')) FROM conversations)""")
def u3(t: Tables):
    split = F.split("text", " ")
    themes = t.benchmark.select(split[0].alias("cluster_theme"), split.alias("subtopics"))
    used = O.labels_in_use(t.conversations.select(F.split("text", " ").alias("w")), "w")
    return O.new_label_candidates(themes, used)


@query("U3_new_label_candidates_any_case", """
SELECT DISTINCT label FROM (SELECT unnest(string_split(text, ' ')) AS label FROM benchmark)
WHERE lower(label) NOT IN (SELECT lower(unnest(string_split(text, ' '))) FROM conversations)""")
def u3_case(t: Tables):
    split = F.split("text", " ")
    themes = t.benchmark.select(split[0].alias("cluster_theme"), split.alias("subtopics"))
    used = O.labels_in_use(t.conversations.select(F.split("text", " ").alias("w")), "w")
    return O.new_label_candidates(themes, used, ignore_case=True)
