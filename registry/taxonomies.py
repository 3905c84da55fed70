"""Taxonomy documents and the label table."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow import operators as O
from labelflow import sources as S
from labelflow.settings import fresh_path

from . import Tables, query
from .derived import PLACES, joined, place_documents, places

# what the per-supplier documents flatten to
FLAT = f"""{PLACES}, flat AS (
  SELECT p.label, CASE level WHEN 1 THEN description WHEN 2 THEN 'Subcategory: ' || p.label ELSE 'Instance: ' || p.label END AS description,
    path, level, parent_path
  FROM places p
  WHERE level = 3 OR EXISTS (SELECT 1 FROM places c WHERE c.level = 3 AND starts_with(c.path, p.path || '/')))"""


@query("S4_T2_three_levels", f"WITH {FLAT} SELECT label, description, path, level, coalesce(parent_path, '') AS parent_path FROM flat")
def t2(t: Tables):
    path = fresh_path(t.spark, "taxonomy")
    place_documents(t).select("body").write.text(path)
    labels = O.flatten_taxonomy(S.read_taxonomy(t.spark, path, "jsonl"))
    return O.first_by_label(labels, "path").select("label", "description", "path", "level", L.blank_to_empty("parent_path").alias("parent_path"))


@query("T2_problems", "SELECT s_suppkey::VARCHAR AS doc, 'note' AS path, 'domain is no map' AS problem FROM supplier")
def t2_problems(t: Tables):
    return O.taxonomy_problems(place_documents(t))


def failing_documents(t: Tables):
    """Per supplier one document: well formed, cut off, with a list as root, or with a number as name."""
    name = F.col("s_name")
    good = F.format_string('{"%s":{"description":"d","subcategories":[{"%s sub":{"instances":[{"x":1}]}}]}}', name, name)
    kind = F.col("s_suppkey") % 4
    body = F.when(kind == 0, good).when(kind == 1, F.substring(good, 1, 20)).when(kind == 2, F.format_string('["%s"]', name)).otherwise(
        F.format_string('{"%s":{"codes":[{"name":%d}]}}', name, F.col("s_suppkey")))
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("doc"), body.alias("body"))


@query("T2_documents_that_fail", """
SELECT s_suppkey::VARCHAR AS doc, '' AS path, CASE s_suppkey % 4 WHEN 1 THEN 'document does not parse' ELSE 'root is no map' END AS problem FROM supplier WHERE s_suppkey % 4 IN (1, 2)
UNION ALL SELECT s_suppkey::VARCHAR, p, 'label' FROM supplier, (VALUES (0), (1), (2)) v(l), LATERAL (SELECT CASE l WHEN 0 THEN s_name WHEN 1 THEN s_name || '/' || s_name || ' sub' ELSE s_name || '/' || s_name || ' sub/x' END AS p) q WHERE s_suppkey % 4 = 0
UNION ALL SELECT s_suppkey::VARCHAR, s_name, 'label' FROM supplier WHERE s_suppkey % 4 = 3""")
def t2_failing(t: Tables):
    docs = failing_documents(t)
    return O.taxonomy_problems(docs).unionByName(O.flatten_taxonomy(docs).select("doc", "path", F.lit("label").alias("problem")))


@query("T3_documents_that_fail", """
SELECT s_suppkey::VARCHAR AS doc, replace(s_name, ' ', '_') || '/codes/' || s_suppkey AS path, s_suppkey::VARCHAR AS label FROM supplier WHERE s_suppkey % 4 = 3
UNION ALL SELECT s_suppkey::VARCHAR, '', 'document does not parse' FROM supplier WHERE s_suppkey % 4 = 1""")
def t3_failing(t: Tables):
    docs = failing_documents(t)
    coded = O.flatten_generic(docs).filter(F.contains("path", F.lit("/codes/"))).select("doc", "path", "label")
    return coded.unionByName(O.generic_problems(docs).withColumnRenamed("problem", "label"))


@query("T1_top_level", """SELECT DISTINCT r_name AS label, 'Region ' || r_name AS description FROM region
JOIN nation ON n_regionkey = r_regionkey JOIN supplier ON s_nationkey = n_nationkey""")
def t1(t: Tables):
    return O.top_level_labels(place_documents(t)).select("label", "description").distinct()


@query("T3_generic", """
WITH rows AS (SELECT r_name, n_name, s_name, replace(r_name, ' ', '_') AS r FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT DISTINCT * FROM (
  SELECT r_name AS label, 'No description' AS description, r AS path FROM rows
  UNION ALL SELECT n_name, 'about ' || n_name, r || '/' || n_name FROM rows
  UNION ALL SELECT 'list', 'x', r || '/' || n_name || '/list/list' FROM rows WHERE false
  UNION ALL SELECT s_name, s_name || ', part of suppliers', r || '/' || n_name || '/suppliers/' || s_name FROM rows
  UNION ALL SELECT 'code ' || s_name, 'No description available', r || '/' || n_name || '/suppliers/code_' || s_name FROM rows
  UNION ALL SELECT 'kind', 'Nation', r || '/' || n_name || '/kind' FROM rows)""")
def t3(t: Tables):
    rows = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    body = F.format_string(
        '{"%s":{"%s":{"description":"about %s","kind":"Nation","suppliers":["%s",{"name":"code %s"},7],"instances":["skipped"]}}}',
        "r_name", "n_name", "n_name", "s_name", "s_name",
    )
    docs = rows.select(F.col("s_suppkey").cast("string").alias("doc"), body.alias("body"))
    return O.flatten_generic(docs).select("label", "description", "path").distinct()


def place_nodes(t: Tables):
    """Regions, nations and suppliers as nodes with their parents."""
    r = t.region.select(F.concat(F.lit("r"), "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("label"))
    n = t.nation.select(F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), "n_name")
    s = t.supplier.select(F.concat(F.lit("s"), "s_suppkey"), F.concat(F.lit("n"), "s_nationkey"), "s_name")
    return r.union(n).union(s)


NODES = """nodes AS (SELECT 'r' || r_regionkey AS node, NULL AS parent, r_name AS label FROM region
  UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey, s_name FROM supplier)"""


@query("T3_recursive_nodes", f"""WITH RECURSIVE {NODES}, way AS (
  SELECT node, label, replace(label, ' ', '_') AS path, 1 AS level, NULL::VARCHAR AS parent_path FROM nodes WHERE parent IS NULL
  UNION ALL SELECT n.node, n.label, way.path || '/' || replace(n.label, ' ', '_'), level + 1, way.path FROM way JOIN nodes n ON n.parent = way.node)
SELECT node, label, path, level, coalesce(parent_path, '') AS parent_path FROM way""")
def t3_nodes(t: Tables):
    flat = O.flatten_nodes(place_nodes(t))
    return flat.select("node", "label", "path", "level", L.blank_to_empty("parent_path").alias("parent_path"))


@query("T10_recursive_ancestors", f"""WITH {NODES}
SELECT a.node, a.parent AS ancestor, 1 AS distance FROM nodes a WHERE a.parent IS NOT NULL
UNION ALL SELECT a.node, b.parent, 2 FROM nodes a JOIN nodes b ON a.parent = b.node WHERE b.parent IS NOT NULL""")
def t10_nodes(t: Tables):
    return O.node_ancestors(O.flatten_nodes(place_nodes(t)))


@query("T3_node_problems", """
SELECT s_suppkey::VARCHAR AS node, CASE s_suppkey % 5 WHEN 0 THEN 'unknown parent' WHEN 3 THEN 'below a cycle'
  ELSE CASE WHEN s_suppkey % 5 = 2 OR s_suppkey + 1 IN (SELECT s_suppkey FROM supplier) THEN 'cycle' ELSE 'unknown parent' END END AS problem
FROM supplier WHERE s_suppkey % 5 <> 4 AND s_suppkey > 3""")
def t3_node_problems(t: Tables):
    """Suppliers by fives: an unknown parent, two that are each other's parent, one below them, a root."""
    s = F.col("s_suppkey")
    parent = F.when(s % 5 == 0, F.lit("none")).when(s % 5 == 1, (s + 1).cast("string")).when(s % 5 < 4, (s - 1).cast("string"))
    nodes = t.supplier.filter(s > 3).select(s.cast("string").alias("node"), parent.alias("parent"), F.col("s_name").alias("label"))
    return O.node_problems(nodes)


@query("T4_first_by_label", """
SELECT p_name AS label, min(p_partkey) AS pos, (SELECT p_brand FROM part q WHERE q.p_partkey = min(part.p_partkey)) AS path FROM part GROUP BY p_name""")
def t4(t: Tables):
    labels = t.part.select(F.col("p_name").alias("label"), F.col("p_partkey").alias("pos"), F.col("p_brand").alias("path"))
    return O.first_by_label(labels)


@query("T4_repeated_labels", "SELECT p_name AS label, count(*) AS copies FROM part GROUP BY 1 HAVING count(*) > 1")
def t4_repeated(t: Tables):
    return O.repeated_labels(t.part.select(F.col("p_name").alias("label")))


@query("T5_distinct_labels", "SELECT DISTINCT p_name AS label FROM part")
def t5(t: Tables):
    return O.distinct_labels(t.part.select(F.col("p_name").alias("label")))


@query("T6_root_labels", "SELECT r_name AS label, 'Region ' || r_name AS description FROM region")
def t6(t: Tables):
    return O.root_labels(places(t)).select("label", "description")


@query("T7_label_paths", f"""WITH {PLACES} SELECT c_custkey, n_name AS label, path
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN places ON label = n_name""")
def t7(t: Tables):
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("n_name").alias("label"))
    return O.label_paths(named, places(t), key="c_custkey").select("c_custkey", "label", "path")


# RE2 has no look-ahead: first set a blank before the last capital of a run, then take the parts
_PIECES = "list_filter(regexp_split_to_array(replace(label, '_', ' '), '\\s+'), lambda p: p <> '')"
_CUT = "list_transform(regexp_extract_all(regexp_replace(p, '([A-Z])([^A-Z])', ' \\1\\2', 'g'), '[A-Z][a-z]+|[A-Z]+(?: |$)'), lambda x: lower(trim(x)))"
NAME_TERMS = f"flatten(list_transform({_PIECES}, lambda p: CASE WHEN len({_CUT}) > 0 THEN {_CUT} ELSE [lower(p)] END))"


@query("T8_name_terms", f"""
WITH l AS (SELECT s_name AS label FROM supplier UNION ALL SELECT n_name FROM nation UNION ALL SELECT p_brand || p_type FROM part
  UNION ALL SELECT 'OpenApi' || r_name || '_' || r_name FROM region)
SELECT label, array_to_string({NAME_TERMS}, '|') AS terms FROM l""")
def t8(t: Tables):
    names = (
        t.supplier.select(F.col("s_name").alias("label")).union(t.nation.select("n_name"))
        .union(t.part.select(F.concat("p_brand", "p_type")))
        .union(t.region.select(F.concat(F.lit("OpenApi"), "r_name", F.lit("_"), "r_name")))
    )
    return names.select("label", joined(L.name_terms("label")).alias("terms"))


@query("T9_description_terms", r"""
SELECT item_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: length(w) > 3), '|') AS terms FROM benchmark""")
def t9(t: Tables):
    return t.benchmark.select("item_id", joined(L.description_terms("text")).alias("terms"))


@query("T10_ancestor_paths", f"""WITH {PLACES}
SELECT path, CASE level WHEN 1 THEN '' WHEN 2 THEN parent_path ELSE split_part(path, '/', 1) || '|' || parent_path END AS ancestors FROM places""")
def t10(t: Tables):
    return places(t).select("path", joined(L.ancestor_paths("path")).alias("ancestors"))


@query("T10_closure_table", f"""WITH {PLACES}
SELECT c.label, array_to_string(list_sort(list(DISTINCT a.label)), '|') AS parents
FROM places c JOIN places a ON starts_with(c.path, a.path || '/') GROUP BY c.label""")
def t10_closure(t: Tables):
    return O.closure_table(places(t)).select("label", joined("parents").alias("parents"))


# -- relations: each supplier is near the next two of its eight, and in its nation and region ------------

EDGES = """places AS (SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
edges AS (
  SELECT s_suppkey::VARCHAR AS doc, s_name AS source, 'near' AS relation, printf('Supplier#%09d', s_suppkey + k) AS target, k = 2 AS inherited
  FROM places, (VALUES (1), (2)) v(k) WHERE s_suppkey % 8 < 6
  UNION ALL SELECT s_suppkey::VARCHAR, s_name, 'in', n_name, FALSE FROM places
  UNION ALL SELECT s_suppkey::VARCHAR, s_name, 'in', r_name, TRUE FROM places
  UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL, 'somewhere', FALSE FROM places WHERE s_suppkey % 8 = 7)"""


def supplier_edges(t: Tables):
    key = F.col("s_suppkey")
    places = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    near = F.format_string('{"near":"Supplier#%09d"},"Supplier#%09d",', key + 1, key + 2)
    listed = F.concat(F.when(key % 8 < 6, near).when(key % 8 == 7, '"somewhere",').otherwise(""), F.format_string('{"in":"%s"},"%s"', "n_name", "r_name"))
    body = F.format_string('{"Suppliers":{"instances":[{"%s":{"type":"Supplier","relationship":[%s]}}]}}', "s_name", listed)
    return O.relation_edges(places.select(key.cast("string").alias("doc"), body.alias("body")))


@query("T3_relation_edges", f"WITH {EDGES} SELECT * FROM edges")
def t3_edges(t: Tables):
    return supplier_edges(t)


@query("T3_relation_problems", f"""WITH {EDGES}
SELECT doc, source, relation, target, 'no relation' AS problem FROM edges WHERE relation IS NULL
UNION ALL SELECT doc, source, relation, target, 'unknown target' FROM edges
WHERE target NOT IN (SELECT s_name FROM supplier) AND target NOT IN (SELECT n_name FROM nation)""")
def t3_relation_problems(t: Tables):
    labels = t.supplier.select(F.col("s_name").alias("label")).union(t.nation.select("n_name"))
    return O.relation_problems(supplier_edges(t), labels)


@query("T3_related", f"""WITH RECURSIVE {EDGES}, way AS (
  SELECT relation, source, target, 1 AS distance FROM edges WHERE relation IS NOT NULL
  UNION SELECT w.relation, w.source, e.target, w.distance + 1 FROM way w JOIN edges e ON e.relation = w.relation AND e.source = w.target)
SELECT relation, source, target, min(distance) AS distance FROM way GROUP BY relation, source, target""")
def t3_related(t: Tables):
    return O.related(supplier_edges(t))
