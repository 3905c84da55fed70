"""Sources, sinks, scalar functions and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow import operators as O
from labelflow import sources as S
from labelflow.plans import clean_records
from labelflow.settings import fresh_path, spread

from . import Tables, query
from .derived import CLEANED, PREPARED, RECORDS, joined, records

FIELDS = "id, url, source, title, content, created_at, metadata"


@query("S1_json_lines", f"WITH {RECORDS} SELECT {FIELDS.replace('id,', 'id::VARCHAR AS id,', 1)} FROM records")
def s1(t: Tables):
    path = fresh_path(t.spark, "records")
    records(t).write.json(path)
    return S.read_records(t.spark, path).select(*FIELDS.split(", "))


@query("S1_text_ids", f"WITH {RECORDS} SELECT 'abc-' || id AS id, url FROM records")
def s1_text(t: Tables):
    path = fresh_path(t.spark, "records")
    records(t).withColumn("id", F.concat(F.lit("abc-"), "id")).write.json(path)
    return S.read_records(t.spark, path).select("id", "url")


@query("S2_column_report", f"""WITH {RECORDS}
SELECT c AS "column", c <> 'domain' AS present, CASE c WHEN 'id' THEN count(id) WHEN 'url' THEN count(url) WHEN 'source' THEN count(source)
  WHEN 'title' THEN count(title) WHEN 'content' THEN count(content) WHEN 'created_at' THEN count(created_at) WHEN 'metadata' THEN count(metadata) ELSE 0 END AS filled
FROM records, (VALUES ('id'),('url'),('source'),('title'),('content'),('created_at'),('domain'),('metadata')) v(c) GROUP BY c""")
def s2(t: Tables):
    return S.column_report(records(t).drop("domain"))


@query("S3_hash_id", f"WITH {RECORDS} SELECT sha256(url || chr(31) || created_at) AS id, count(*) AS n FROM records GROUP BY 1")
def s3(t: Tables):
    return S.with_row_id(records(t).drop("id")).groupBy("id").agg(F.count("*").alias("n"))


@query("S3_dense_id", """SELECT 'bookmark_' || (row_number() OVER (ORDER BY floor(event_id / 1000) % 3, event_id) - 1) AS id, event_id FROM events""")
def s3_dense(t: Tables):
    """Events in three files of other sizes, each in order of the id; rows are numbered file by file."""
    path = fresh_path(t.spark, "events")
    part = (F.floor(F.col("event_id") / 1000) % 3).cast("int")
    rows = t.events.select("event_id", part.alias("part"))
    rows.repartitionByRange(3, "part").sortWithinPartitions("part", "event_id").write.partitionBy("part").parquet(path)
    return S.with_row_id(t.spark.read.parquet(path).select("event_id"), dense=True).select("id", "event_id")


@query("S3_cast_id", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus FROM orders")
def s3_cast(t: Tables):
    return S.with_row_id(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query("S5_csv", f"""WITH {RECORDS}
SELECT id, source, created_at, content, CASE WHEN lang = 'fr' THEN '' ELSE lang || ', ' || source END AS existing_tags
FROM records JOIN (SELECT doc_id, lang FROM documents) d ON d.doc_id = id""")
def s5(t: Tables):
    path = fresh_path(t.spark, "flat")
    S.write_csv(records(t).select("id", "source", "created_at", "content", "metadata", L.extract_tags("metadata", "tags").alias("existing_tags")), path)
    back = t.spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return back.select(F.col("id").cast("bigint").alias("id"), "source", "created_at", "content", F.coalesce("existing_tags", F.lit("")).alias("existing_tags"))


@query("S5_csv_quotes", "SELECT page_id, html FROM pages")
def s5_quotes(t: Tables):
    """Pages hold quotes, commas and line ends."""
    path = fresh_path(t.spark, "flat")
    S.write_csv(t.pages.select("page_id", "html"), path)
    back = t.spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return back.select(F.col("page_id").cast("bigint").alias("page_id"), "html")


@query("S6_flat_columns", "SELECT doc_id, lang || ', ' || source AS tags, n_chars::VARCHAR AS sizes FROM documents")
def s6(t: Tables):
    wide = t.documents.select(
        "doc_id", F.array("lang", "source").alias("tags"), F.array("n_chars").alias("sizes"),
        F.array("n_chars").alias("tag_scores"), F.array("lang").alias("tag_paths_k"), F.col("lang").alias("metadata"),
    )
    return S.flat_columns(wide)


@query("S5_csv_list_literals", """
SELECT doc_id, '[' || chr(39) || lang || chr(39) || ', ' || chr(39) || source || chr(39) || ']' AS tags, '[]' AS none FROM documents""")
def s5_literals(t: Tables):
    path = fresh_path(t.spark, "flat")
    S.write_csv(t.documents.select("doc_id", F.array("lang", "source").alias("tags"), L.empty_strings().alias("none")), path, skip=(), literals=True)
    return t.spark.read.option("header", True).option("escape", '"').schema("doc_id long, tags string, none string").csv(path)


@query("S7_json_lines_out", f"""WITH {RECORDS}
SELECT id, (title IS NULL)::INT AS no_title, content, created_at,
  CASE WHEN try_cast(created_at AS TIMESTAMPTZ) IS NOT NULL THEN epoch_us(try_cast(created_at AS TIMESTAMPTZ)) END AS us
FROM records""")
def s7(t: Tables):
    path = fresh_path(t.spark, "lines")
    S.write_json_lines(records(t).withColumn("dt", L.parse_time("created_at")), path)
    raw = t.spark.read.text(path).select(F.from_json("value", "map<string,string>").alias("m"))
    # a NULL title is written as an explicit null
    return raw.filter(F.map_contains_key("m", "title")).select(
        F.col("m.id").cast("bigint").alias("id"), F.col("m.title").isNull().cast("int").alias("no_title"),
        F.col("m.content").alias("content"), F.col("m.created_at").alias("created_at"),
        F.unix_micros(F.try_to_timestamp("m.dt")).alias("us"),
    )


@query("S8_suggestions", """
SELECT label AS cluster_id, count(*) AS cluster_size, min(vec_id)::VARCHAR AS potential_new_entities,
  '' AS thematic_gap_suggestions, 'Class_' || label AS assigned_labels_in_cluster
FROM embeddings GROUP BY label""")
def s8(t: Tables):
    path = fresh_path(t.spark, "suggestions")
    found = t.embeddings.groupBy(F.col("label").alias("cluster_id")).agg(
        F.array(F.concat(F.lit("Class_"), F.first("label").cast("string"))).alias("assigned_labels_in_cluster"),
        F.array(F.min("vec_id").cast("string")).alias("potential_new_entities"),
        L.empty_strings().alias("thematic_gap_suggestions"), F.count("*").alias("cluster_size"),
    )
    S.write_suggestions(found, path)
    names = "array<string>"
    back = t.spark.read.schema(
        f"cluster_id int, cluster_size long, potential_new_entities {names}, thematic_gap_suggestions {names}, assigned_labels_in_cluster {names}"
    ).json(path)
    return back.select("cluster_id", "cluster_size", *[joined(c).alias(c) for c in S.SUGGESTION_COLUMNS[2:]])


@query("S9_keep_columns", "SELECT doc_id, source, n_chars FROM documents")
def s9(t: Tables):
    return S.keep_columns(t.documents, ["doc_id", "source", "absent", "n_chars"])[0]


@query("S10_manifest", """
SELECT 'run-1' AS run_id, (SELECT count(*) FROM documents) AS total_records,
  (SELECT count(DISTINCT source) FROM documents) AS total_unique_labels, 'enriched=out/enriched|stats=out/stats' AS files""")
def s10(t: Tables):
    path = fresh_path(t.spark, "summary")
    stats = O.label_statistics(t.documents.select(F.array("source").alias("l")), "l")
    S.write_manifest(S.run_manifest(t.documents, {"enriched": "out/enriched", "stats": "out/stats"}, "run-1", stats), path)
    back = t.spark.read.json(path)
    files = F.transform("files_created", lambda f: F.concat(f["name"], F.lit("="), f["path"]))
    return back.select("run_id", "total_records", "total_unique_labels", joined(files).alias("files"))


@query("S11_vector_index", """
SELECT vec_id AS key, len(embedding)::INT AS dim, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm
FROM embeddings""")
def s11(t: Tables):
    path = fresh_path(t.spark, "index")
    S.write_index(t.embeddings, path, "vec_id", "embedding")
    return S.read_index(t.spark, path).select("key", F.size("vector").alias("dim"), F.round("norm", 6).alias("norm"))


# -- scalar functions -----------------------------------------------------------------------------

_VISIBLE = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[^>]+>', '', 'g')"""
for _entity, _char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
    _VISIBLE = f"replace({_VISIBLE}, '{_entity}', '{_char}')"
PAGE_TEXT = rf"trim(regexp_replace({_VISIBLE}, '\s+', ' ', 'g'))"


@query("P1_clean_text", f"SELECT page_id, {PAGE_TEXT} AS text FROM pages")
def p1(t: Tables):
    return spread(t.pages.select("page_id", "html")).select("page_id", L.clean_text("html").alias("text"))


@query("P1_clean_text_sql_mode", f"SELECT page_id, {PAGE_TEXT} AS text FROM pages")
def p1_sql(t: Tables):
    return spread(t.pages.select("page_id", "html")).select("page_id", L.clean_text("html", "sql").alias("text"))


@query("P2_clean_text_flagged", f"SELECT page_id, {PAGE_TEXT} AS text, 0 AS failed FROM pages")
def p2(t: Tables):
    cleaned = spread(t.pages.select("page_id", "html")).withColumn("c", L.clean_text_flagged("html"))
    return cleaned.select("page_id", "c.text", F.col("c.failed").cast("int").alias("failed"))


@query("P3_drop_empty", f"WITH {CLEANED} SELECT id, cleaned_title, cleaned_content FROM cleaned WHERE cleaned_title <> '' OR cleaned_content <> ''")
def p3(t: Tables):
    return clean_records(records(t)).select("id", "cleaned_title", "cleaned_content")


@query("P3b_drop_blank", f"WITH {CLEANED} SELECT id FROM cleaned WHERE cleaned_title <> '' OR id % 3 > 0")
def p3_blank(t: Tables):
    """A third of the contents holds blanks only."""
    blank = F.when(F.col("id") % 3 == 0, F.lit(" \t\n ")).otherwise(F.col("content"))
    return clean_records(records(t).withColumn("content", blank)).select("id")


@query("P4_fill_empty", f"WITH {RECORDS} SELECT id, coalesce(title, '') AS title, coalesce(domain, '') AS domain FROM records")
def p4(t: Tables):
    return records(t).select("id", L.blank_to_empty("title").alias("title"), L.blank_to_empty("domain").alias("domain"))


@query("P5_parse_time", f"WITH {RECORDS} SELECT id, epoch_us(try_cast(created_at AS TIMESTAMPTZ)) AS us FROM records")
def p5(t: Tables):
    return records(t).select("id", F.unix_micros(L.parse_time("created_at")).alias("us"))


@query("P6_combined_text", f"WITH {CLEANED} SELECT id, trim(cleaned_title || ' ' || cleaned_content) AS combined_text, cleaned_title || ' ' || cleaned_content AS untrimmed FROM cleaned")
def p6(t: Tables):
    both = clean_records(records(t))
    return both.select("id", L.combine_text("cleaned_title", "cleaned_content").alias("combined_text"),
                       L.combine_text("cleaned_title", "cleaned_content", trim=False).alias("untrimmed"))


@query("P7_summary_text", f"WITH {RECORDS} SELECT id, coalesce(title, '') || ' | Summary: ' || content AS summary_and_title FROM records")
def p7(t: Tables):
    return records(t).select("id", L.summary_text("title", "content").alias("summary_and_title"))


@query("P8_existing_tags", f"""WITH {RECORDS}
SELECT id, CASE WHEN json_type(metadata, '$.tags') = 'ARRAY' THEN array_to_string(json_extract_string(metadata, '$.tags[*]'), '|') ELSE '' END AS tags,
  '' AS absent FROM records""")
def p8(t: Tables):
    return records(t).select("id", joined(L.extract_tags("metadata", "tags")).alias("tags"), joined(L.extract_tags("metadata")).alias("absent"))


TAG_KINDS = f"""WITH {RECORDS}, tags AS (SELECT id, lang, source FROM records JOIN (SELECT doc_id, lang FROM documents) d ON doc_id = id)
SELECT id, lang || '|' || source AS of_struct, lang AS of_map, source AS of_variant, lang || '|' || source AS of_json, '' AS of_texts, source AS of_dotted FROM tags"""


@query("P8_metadata_kinds", TAG_KINDS)
def p8_kinds(t: Tables):
    d = t.documents
    lists = {"s": F.array("lang", "source"), "m": F.array("lang"), "v": F.array("source")}
    json = F.to_json(F.struct(lists["s"].alias("tags"), lists["v"].alias("a.b")))
    rows = d.select(
        F.col("doc_id").alias("id"), F.struct(lists["s"].alias("tags"), F.lit(1).alias("other")).alias("struct"), F.create_map(F.lit("tags"), lists["m"]).alias("map"),
        F.parse_json(F.to_json(F.struct(lists["v"].alias("tags")))).alias("variant"), json.alias("json"), F.create_map(F.lit("tags"), "lang").alias("texts"))
    found = {
        "of_struct": L.extract_tags("struct", "tags", "nested"), "of_map": L.extract_tags("map", "tags", "nested"), "of_variant": L.extract_tags("variant", "tags", "variant"),
        "of_json": L.extract_tags("json", "tags"), "of_texts": L.extract_tags("texts", "tags", "nested"), "of_dotted": L.extract_tags("json", "a.b"),
    }
    return rows.select("id", *[joined(c).alias(n) for n, c in found.items()])


@query("P8_prepare_struct_metadata", f"""WITH {PREPARED} SELECT id, lang || '|' || source AS tags FROM prepared JOIN (SELECT doc_id, lang FROM documents) d ON doc_id = id""")
def p8_prepare(t: Tables):
    from labelflow.plans import prepare

    tags = t.documents.select(F.col("doc_id").alias("id"), F.struct(F.array("lang", "source").alias("tags")).alias("metadata"))
    done = prepare(records(t).drop("metadata").join(tags, "id"), tag_key="tags")
    return done.select("id", joined("existing_tags").alias("tags"))


@query("P8_tags_of_event_props", "SELECT event_id, 0 AS n FROM events")
def p8_events(t: Tables):
    return t.events.select("event_id", F.size(L.extract_tags("props", "k")).alias("n"))


@query("P9_text_length", f"WITH {RECORDS} SELECT id, coalesce(length(title), 0) AS title_length, length(content) AS content_length FROM records")
def p9(t: Tables):
    return records(t).select("id", L.text_length("title").alias("title_length"), L.text_length("content").alias("content_length"))


@query("P10_rename_drop", "SELECT doc_id AS id, lang AS language, source FROM documents")
def p10(t: Tables):
    return t.documents.withColumnsRenamed({"doc_id": "id", "lang": "language"}).drop("text", "n_chars")


@query("P12_null_lists", "SELECT doc_id, CASE WHEN lang = 'en' THEN source ELSE '' END AS tags, 0 AS candidates FROM documents")
def p12(t: Tables):
    tags = F.when(F.col("lang") == "en", F.array("source"))
    return t.documents.select("doc_id", joined(L.or_empty(tags)).alias("tags"), F.size(L.empty_strings()).alias("candidates"))


@query("P13_default_columns", "SELECT doc_id, -1 AS cluster_id, '' AS content_summary FROM documents")
def p13(t: Tables):
    return t.documents.select("doc_id", F.lit(-1).alias("cluster_id"), L.blank_to_empty(F.lit(None).cast("string")).alias("content_summary"))


@query("P14_label_plus_desc", "SELECT item_id, 'Passage_' || item_id || ': ' || text AS a, 'Passage_' || item_id || ': No description' AS b FROM benchmark")
def p14(t: Tables):
    name = F.concat(F.lit("Passage_"), F.col("item_id").cast("string"))
    return t.benchmark.select("item_id", L.label_plus_desc(name, "text").alias("a"),
                              L.label_plus_desc(name, F.lit(None).cast("string")).alias("b"))


@query("P15_non_blank", f"WITH {RECORDS} SELECT id FROM records WHERE trim(coalesce(title, '')) <> ''")
def p15(t: Tables):
    return records(t).filter(F.trim(L.blank_to_empty("title")) != "").select("id")


@query("P16_escape_prompt", r"""SELECT doc_id, replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), ' '), chr(13), '') AS escaped FROM documents""")
def p16(t: Tables):
    return t.documents.select("doc_id", L.escape_prompt("text").alias("escaped"))


@query("P17_preview", "SELECT doc_id, CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '...' ELSE text END AS preview FROM documents")
def p17(t: Tables):
    return t.documents.select("doc_id", L.preview("text", 200).alias("preview"))


@query("P18_contains", "SELECT doc_id, contains(lower(text), 'the')::INT AS hit FROM documents")
def p18(t: Tables):
    return t.documents.select("doc_id", F.contains(F.lower("text"), F.lit("the")).cast("int").alias("hit"))


@query("P19_split_items", r"""
SELECT conv_id, turn, array_to_string(list_filter(list_transform(string_split(text, ','), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), '|') AS items,
  len(string_split(text, chr(10)))::INT AS lines
FROM conversations""")
def p19(t: Tables):
    return t.conversations.select("conv_id", "turn", joined(L.split_items("text")).alias("items"),
                                  F.size(L.split_items("text", "\n", keep_empty=True)).alias("lines"))


@query("P20_none_reply", "SELECT doc_id, (quality = 0)::INT AS none FROM labels")
def p20(t: Tables):
    reply = F.when(F.col("quality") == 0, F.lit(" None\n")).otherwise("Nonesuch")
    return t.labels.select("doc_id", L.is_none_reply(reply).cast("int").alias("none"))


@query("P21_percentage", "SELECT source, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2) AS percentage FROM documents GROUP BY source")
def p21(t: Tables):
    total = t.documents.agg(F.count("*")).scalar()
    return t.documents.groupBy("source").agg(F.count("*").alias("n")).select("source", L.percentage("n", total).alias("percentage"))


# -- duplicates -----------------------------------------------------------------------------------

HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"


def hosted(t: Tables):
    return t.pages.select("page_id", "url", F.parse_url("url", F.lit("HOST")).alias("host"))


@query("D1_count_duplicates", f"SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT {HOST} AS host, count(*) AS n FROM pages GROUP BY 1)")
def d1(t: Tables):
    return O.count_duplicates(hosted(t), "host")


@query("D1_count_duplicate_texts", "SELECT sum(n - 1)::BIGINT AS duplicates FROM (SELECT text, count(*) AS n FROM documents GROUP BY 1)")
def d1_text(t: Tables):
    return O.count_duplicates(t.documents, "text")


@query("D2_keep_newest", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def d2(t: Tables):
    return O.keep_newest(t.events, "user_id", "ts", "event_id").select("event_id", "user_id", "event_type", "value")


@query("D2_keep_newest_undated", f"""WITH {CLEANED}
SELECT id, url, created_us FROM cleaned QUALIFY row_number() OVER (PARTITION BY source ORDER BY created_us DESC NULLS LAST, id) = 1""")
def d2_undated(t: Tables):
    dated = records(t).withColumn("dt", L.parse_time("created_at"))
    return O.keep_newest(dated, "source", "dt").select("id", "url", F.unix_micros("dt").alias("created_us"))


@query("D3_keep_first", f"SELECT page_id, {HOST} AS host FROM pages QUALIFY row_number() OVER (PARTITION BY {HOST} ORDER BY page_id) = 1")
def d3(t: Tables):
    return O.keep_first(hosted(t), "host", "page_id").select("page_id", "host")


STAGES = """
SELECT 'titled' AS stage, count(*) FILTER (lang <> 'de') AS kept, count(*) FILTER (lang = 'de') AS dropped FROM documents
UNION ALL SELECT 'dated', count(*) FILTER (lang <> 'es'), count(*) FILTER (lang = 'es') FROM documents"""


@query("D4_stage_counts", STAGES)
def d4(t: Tables):
    return O.stage_counts(records(t), {"titled": F.col("title").isNotNull(), "dated": L.parse_time("created_at").isNotNull()})


@query("D4_observed_counts", STAGES)
def d4_observed(t: Tables):
    stages = {"titled": F.col("title").isNotNull(), "dated": L.parse_time("created_at").isNotNull()}
    return O.write_counted(records(t), "records", stages)[1]
