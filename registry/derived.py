"""Inputs that Spark derives from the given tables, and the same inputs in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.settings import fresh_path, spread

from . import Tables


def joined(c: str | Column, by: str = "|") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.array_join(c.cast("array<string>"), by)


# -- records: documents with a title, a URL that equal texts of one source share, a date and tags --

def records(t: Tables) -> DataFrame:
    return spread(t.documents).select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("http://"), "source", F.lit(".example.com/"), F.md5(F.col("text").cast("binary"))).alias("url"),
        "source",
        F.when(F.col("lang") != "de", F.concat(F.lit("<b>"), "lang", F.lit("</b> &amp;  "), "source")).alias("title"),
        F.col("text").alias("content"),
        F.when(F.col("lang") == "es", "unknown").otherwise(
            F.concat(F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), F.col("n_chars").cast("int")), "yyyy-MM-dd"),
                     F.lit(" 10:00:00+00:00"))
        ).alias("created_at"),
        F.lit(None).cast("string").alias("domain"),
        F.when(F.col("lang") == "fr", F.concat(F.lit('{"tags":"'), "source", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"folder":"f","tags":["'), "lang", F.lit('","'), "source", F.lit('"]}'))).alias("metadata"),
    )


RECORDS = r"""records AS (
  SELECT doc_id AS id, 'http://' || source || '.example.com/' || md5(text) AS url, source,
    CASE WHEN lang <> 'de' THEN '<b>' || lang || '</b> &amp;  ' || source END AS title, text AS content,
    CASE WHEN lang = 'es' THEN 'unknown'
         ELSE strftime(DATE '2000-01-01' + n_chars::INT, '%Y-%m-%d') || ' 10:00:00+00:00' END AS created_at,
    NULL::VARCHAR AS domain,
    CASE WHEN lang = 'fr' THEN '{"tags":"' || source || '"}'
         ELSE '{"folder":"f","tags":["' || lang || '","' || source || '"]}' END AS metadata
  FROM documents)"""

CLEANED = RECORDS + r""", cleaned AS (
  SELECT *, CASE WHEN title IS NULL THEN '' ELSE regexp_extract(title, '<b>(..)</b>', 1) || ' & ' || source END AS cleaned_title,
    trim(regexp_replace(content, '\s+', ' ', 'g')) AS cleaned_content,
    epoch_us(try_cast(created_at AS TIMESTAMPTZ)) AS created_us
  FROM records)"""

PREPARED = CLEANED + r""", prepared AS (
  SELECT *, trim(cleaned_title || ' ' || cleaned_content) AS combined_text
  FROM cleaned WHERE cleaned_title <> '' OR cleaned_content <> ''
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY created_us DESC NULLS LAST, id) = 1)"""


# -- labels: one per benchmark passage ------------------------------------------------------------

def passages(t: Tables) -> DataFrame:
    name = F.concat(F.lit("Passage_"), F.col("item_id").cast("string"))
    return t.benchmark.select(
        name.alias("label"), F.col("text").alias("description"), name.alias("path"), F.col("item_id").alias("pos")
    )


PASSAGE_TERMS = r"""terms AS (
  SELECT item_id AS pos, 'Passage_' || item_id AS label,
    unnest(list_concat(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda w: length(w) > 3),
                       ['passage', item_id::VARCHAR])) AS term
  FROM benchmark)"""


# -- hierarchy: region / nation / supplier --------------------------------------------------------

def places(t: Tables) -> DataFrame:
    r, n, s = t.region, t.nation, t.supplier
    rn = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    rns = s.join(rn, F.col("s_nationkey") == F.col("n_nationkey"))
    top = r.select(
        F.col("r_name").alias("label"), F.concat(F.lit("Region "), "r_name").alias("description"),
        F.col("r_name").alias("path"), F.lit(1).alias("level"), F.lit(None).cast("string").alias("parent_path"),
        F.array(F.col("r_regionkey").cast("bigint")).alias("pos"),
    )
    middle = rn.select(
        F.col("n_name").alias("label"), F.concat(F.lit("Nation of "), "r_name").alias("description"),
        F.concat_ws("/", "r_name", "n_name").alias("path"), F.lit(2).alias("level"), F.col("r_name").alias("parent_path"),
        F.array(F.col("r_regionkey").cast("bigint"), F.col("n_nationkey").cast("bigint")).alias("pos"),
    )
    leaf = rns.select(
        F.col("s_name").alias("label"), F.lit(None).cast("string").alias("description"),
        F.concat_ws("/", "r_name", "n_name", "s_name").alias("path"), F.lit(3).alias("level"),
        F.concat_ws("/", "r_name", "n_name").alias("parent_path"),
        F.array(F.col("r_regionkey").cast("bigint"), F.col("n_nationkey").cast("bigint"), F.col("s_suppkey")).alias("pos"),
    )
    return top.unionByName(middle).unionByName(leaf)


PLACES = r"""places AS (
  SELECT r_name AS label, 'Region ' || r_name AS description, r_name AS path, 1 AS level, NULL::VARCHAR AS parent_path FROM region
  UNION ALL SELECT n_name, 'Nation of ' || r_name, r_name || '/' || n_name, 2, r_name
    FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT s_name, NULL, r_name || '/' || n_name || '/' || s_name, 3, r_name || '/' || n_name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def place_documents(t: Tables) -> DataFrame:
    """One small taxonomy document per supplier, with a root entry that is no map."""
    rows = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    body = F.format_string(
        '{"%s":{"description":"Region %s","subcategories":[{"%s":{"type":"Nation","instances":[{"%s":{"type":"Supplier"}}]}}]},'
        '"note":"no map"}',
        "r_name", "r_name", "n_name", "s_name",
    )
    return rows.select(F.col("s_suppkey").cast("string").alias("doc"), body.alias("body"))


# -- labelled records: the words of each document that are label names ------------------------------

_STORED: dict[str, str] = {}
TASK_LINES = 1_000_000  # lines of orders that a task gathers, on average at most


def store_order_labels(t: Tables) -> None:
    """Write the fixture once, so that a benchmark times the operators and not the join that feeds them."""
    path = fresh_path(t.spark, "order_labels")
    order_labels(t).write.parquet(path)
    _STORED[t.folder] = path


def order_labels(t: Tables) -> DataFrame:
    """Per supplier and order the place labels: the supplier, and the nation of the customer."""
    if t.folder in _STORED:
        return t.spark.read.parquet(_STORED[t.folder])
    sold = t.lineitem.select("l_orderkey", "l_suppkey").join(t.supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    bought = (
        t.orders.select("o_orderkey", "o_custkey").join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    # lists are gathered on either side of the join; more lines are more tasks, not larger ones
    n = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), -(-t.lineitem.count() // TASK_LINES))
    sellers = sold.select(F.col("l_orderkey").alias("id"), "s_name").repartition(n, "id").groupBy("id").agg(F.array_sort(F.collect_set("s_name")).alias("suppliers"))
    buyers = bought.select(F.col("o_orderkey").alias("id"), "n_name").repartition(n, "id").groupBy("id").agg(F.max("n_name").alias("nation"))
    return sellers.join(buyers, "id").select("id", F.concat("suppliers", F.array("nation")).alias("labels"))


ORDER_LABELS = r"""order_labels AS (
  SELECT o_orderkey AS id, list_concat(list_sort(list_distinct(list(s_name))), [max(n_name)]) AS labels
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY o_orderkey)"""


# -- vectors: the first vector of each class stands for the class ----------------------------------

def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").cast("string").alias("own"))


def prototypes(t: Tables) -> DataFrame:
    firsts = vectors(t).groupBy("own").agg(F.min_by("vector", "id").alias("vector"), F.min("id").alias("id"))
    name = F.concat(F.lit("Class_"), "own")
    return firsts.select(
        name.alias("label"), F.concat(F.lit("classes/"), name).alias("path"),
        F.concat(F.lit("vector "), F.col("id").cast("string")).alias("description"), "vector",
    )


PROTOTYPES = r"""protos AS (
  SELECT 'Class_' || label AS label, 'classes/Class_' || label AS path, 'vector ' || min(vec_id) AS description,
    arg_min(embedding, vec_id)::DOUBLE[] AS v
  FROM embeddings GROUP BY embeddings.label)"""

NEAREST = PROTOTYPES + r""", nearest AS (
  SELECT vec_id AS id, p.label, p.path, p.description,
    round(list_cosine_similarity(embedding::DOUBLE[], v), 6) AS score,
    row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(embedding::DOUBLE[], v), 6) DESC, p.label) AS rank
  FROM embeddings, protos p)"""


# -- replies: assistant turns ------------------------------------------------------------------------

def replies(t: Tables) -> DataFrame:
    said = t.conversations.filter("role = 'assistant'")
    return said.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("reply"))


def phrases(t: Tables) -> DataFrame:
    """Labels: the comma-separated phrases of the user turns."""
    said = t.conversations.filter("role = 'user'")
    items = said.select(F.explode(F.split("text", ",")).alias("p")).select(F.trim(F.regexp_replace("p", r"\s+", " ")).alias("label"))
    return items.filter("label <> ''").distinct().select(
        "label", F.col("label").alias("description"), F.col("label").alias("path"), F.col("label").alias("pos")
    )


REPLIES = r"""replies AS (
  SELECT conv_id || '-' || turn AS id, text AS reply FROM conversations WHERE role = 'assistant'),
phrases AS (
  SELECT DISTINCT trim(regexp_replace(p, '\s+', ' ', 'g')) AS label
  FROM (SELECT unnest(string_split(text, ',')) AS p FROM conversations WHERE role = 'user') WHERE trim(regexp_replace(p, '\s+', ' ', 'g')) <> '')"""
