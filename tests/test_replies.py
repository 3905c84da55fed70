import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import plans as P

REPLIES = [
    ("A, C ,B", "ok", ["A", "C"]), ("a, A", "ok", ["A"]), ("A, A", "ok", ["A", "A"]), ("X, Y", "ok", []),
    ("none", "ok", ["Key"]), ("NONE", "ok", ["Key"]), ("", "ok", ["Key"]), ("A", "error", ["Key"]),
]


def labels(spark):
    return spark.createDataFrame(
        [(n, n, i) for i, n in enumerate("ABC")] + [("Key", "matching words", 9)], "label string, description string, pos int"
    )


@pytest.fixture
def records(spark):
    return spark.createDataFrame([(i, "zzz words") for i in range(len(REPLIES) + 1)], "id int, text string")


@pytest.fixture
def replies(spark):
    rows = [(i, r, s) for i, (r, s, _) in enumerate(REPLIES)]
    return spark.createDataFrame(rows, "id int, reply string, status string").withColumn("request_id", F.col("id").cast("string"))


def assigned(df):
    return [r["assigned_labels"] for r in df.orderBy("id").collect()]


def test_assign_by_reply(spark, records, replies):
    got = assigned(O.assign_by_reply(records, replies, "text", labels(spark), 2))
    # the last record has no reply at all
    assert got == [want for _, _, want in REPLIES] + [["Key"]]


def test_assign_variants(spark, records, replies):
    got = assigned(O.assign_by_reply(records, replies, "text", labels(spark), 2, fallback_on=("none", "error", "invalid")))
    assert got[3] == ["Key"]
    got = assigned(O.assign_by_reply(records, replies, "text", labels(spark), 2, on_error="empty"))
    assert got[7] == [] and got[8] == [] and got[4] == ["Key"]


def test_blanks_around_none(spark):
    df = spark.createDataFrame([(0, "zzz words")], "id int, text string")
    said = spark.createDataFrame([("0", "None\n", "ok")], "request_id string, reply string, status string")
    assert assigned(O.assign_by_reply(df, said, "text", labels(spark))) == [["Key"]]
    assert assigned(O.assign_by_reply(df, said, "text", labels(spark), trim_none=False)) == [[]]


def test_replay_and_batch_provider(spark, records, replies):
    asked = O.classification_requests(records, "text", labels(spark), 2)
    said = O.replay_provider(replies)(asked)
    assert said.filter("status = 'error'").count() == 2

    def answer(batches):
        for b in batches:
            yield pd.DataFrame({"request_id": b["request_id"], "reply": "B", "status": "ok"})

    done = O.assign_by_reply(records, O.batch_provider(answer)(asked), "text", labels(spark), 2)
    assert set(map(tuple, assigned(done))) == {("B",)}


def test_requests_list_labels_in_order(spark, records):
    prompt = O.classification_requests(records, "text", labels(spark), 2).first()["prompt"]
    assert "1. A: A\n2. B: B\n3. C: C\n4. Key: matching words" in prompt
    assert "zzz words" in prompt and "at most 2" in prompt


def test_slots_in_text_are_not_filled(spark):
    df = spark.createDataFrame([(1, "see {labels}")], "id int, text string")
    prompt = O.classification_requests(df, "text", labels(spark), 2).first()["prompt"]
    assert "see {labels}" in prompt


def test_a_long_label_list_is_asked_page_by_page(spark, records):
    names = [f"Label{n:02d}" for n in range(23)]
    many = spark.createDataFrame([(n, "some words", n, i) for i, n in enumerate(names)], "label string, description string, path string, pos int")
    asked = O.classification_requests(records, "text", many, page_bytes=200)
    rows = asked.collect()
    pages = max(r["page"] for r in rows)
    assert pages > 2 and len(rows) == pages * records.count() and max(len(r["prompt"]) for r in rows) < 900
    first = sorted((r for r in rows if r["id"] == rows[0]["id"]), key=lambda r: r["page"])
    assert [n for r in first for n in names if n in r["prompt"]] == names
    assert {r["request_id"] for r in first} == {f"{rows[0]['id']}#{p}" for p in range(1, pages + 1)}
    said = asked.select("request_id", F.when(F.col("page") == 2, "None").otherwise(F.concat(F.lit("Label0"), F.col("page") * 2)).alias("reply"),
                        F.when(F.col("page") == 3, "error").otherwise("ok").alias("status"))
    joined = O.join_pages(asked, said.unionByName(said)).filter(F.col("request_id") == str(rows[0]["id"])).first()
    assert joined["status"] == "ok" and joined["reply"].split(", ")[0] == "Label02" and "None" not in joined["reply"] and "Label06" not in joined["reply"]


def test_requests_have_one_shape_for_any_list(spark, records):
    one = O.classification_requests(records, "text", labels(spark))
    many = O.classification_requests(records, "text", labels(spark), page_bytes=20)
    assert one.columns == many.columns and one.dtypes == many.dtypes
    assert {r["page"] for r in one.collect()} == {1} and many.count() > one.count()
    said = one.select("request_id", F.lit("A, B").alias("reply"), F.lit("ok").alias("status"))
    assert sorted(map(tuple, O.join_pages(one, said).collect())) == sorted(map(tuple, said.collect()))


def test_a_page_limit_changes_no_label(spark, records):
    """A provider that reads its prompt: it picks the labels of the list whose name stands in the text."""
    import pandas as pd

    def read(batches):
        for b in batches:
            replies = []
            for prompt in b["prompt"]:
                text, listed = prompt.split("Labels:\n")
                names = [line.split(". ", 1)[1].split(":")[0] for line in listed.split("\n\n")[0].split("\n")]
                replies.append(", ".join(n for n in names if n.lower() in text.lower()) or "None")
            yield pd.DataFrame({"request_id": b["request_id"], "reply": replies, "status": "ok"})

    many = spark.createDataFrame([(n, None, n, i) for i, n in enumerate(["zero", "one", "two", "three", "four", "five"])], "label string, description string, path string, pos int")
    texts = spark.createDataFrame([("1", "http://a", "one and five"), ("2", "http://b", "nothing at all"), ("3", "http://c", "four, two, zero")], "id string, url string, content string")
    whole = sorted((r["id"], r["assigned_labels"]) for r in P.enrich_flat(texts, many, O.batch_provider(read), fallback_on=()).collect())
    assert whole == [("1", ["one", "five"]), ("2", []), ("3", ["zero", "two", "four"])]
    spark.conf.set("spark.labelflow.inlineBytes", "20")
    try:
        assert sorted((r["id"], r["assigned_labels"]) for r in P.enrich_flat(texts, many, O.batch_provider(read), fallback_on=()).collect()) == whole
        # no prompt is made for a provider that reads none
        assert "prompt" not in O.classification_requests(texts, "content", many, prompt=False).columns
        replay = O.replay_provider(spark.createDataFrame([("1", "two", "ok")], "request_id string, reply string, status string"))
        assert P.enrich_flat(texts, many, replay, fallback_on=()).filter("id = 1").first()["assigned_labels"] == ["two"]
    finally:
        spark.conf.unset("spark.labelflow.inlineBytes")


def test_one_reply_for_each_request(spark):
    said = spark.createDataFrame(
        [("1", None, "error", 1), ("1", "B", "ok", 3), ("1", "A", "ok", 2), ("2", "x", "error", 1), ("2", "x", "error", 2), (None, "y", "ok", 1)],
        "request_id string, reply string, status string, attempt int")
    assert sorted((r["request_id"], r["reply"]) for r in O.one_reply(said).collect()) == [("1", "A"), ("2", "x")]
    df = spark.createDataFrame([(1, ["A", "B"]), (2, ["A"]), (None, ["A"])], "id int, candidate_labels array<string>")
    rows = O.verify_candidates(df, said).collect()
    assert sorted((str(r["id"]), r["llm_verified_labels"]) for r in rows) == [("1", ["A"]), ("2", []), ("None", [])]
    replayed = O.replay_provider(said)(spark.createDataFrame([("1",), ("2",), ("3",)], "request_id string")).collect()
    assert sorted((r["request_id"], r["status"]) for r in replayed) == [("1", "ok"), ("2", "error"), ("3", "error")]


def test_short_words_count_for_themes(spark):
    asked = spark.createDataFrame([("1", "SQL SQL SQL API API LLM word"), ("2", "")], "request_id string, text string")
    got = {r["request_id"]: r["reply"] for r in O.theme_reply(2)(asked).collect()}
    assert got == {"1": '{"cluster_theme":"sql","subtopics":["api","llm"]}', "2": ""}


def test_verification(spark):
    df = spark.createDataFrame(
        [(1, "t\n1", ["A", "B"], ["da", 'd"b']), (2, "t2", ["A"], ["x", "y"]), (3, "t3", [], []), (4, "t4", None, None)],
        "id int, combined_text string, candidate_labels array<string>, candidate_descriptions array<string>",
    )
    prompts = {r["id"]: r["prompt"] for r in O.verification_requests(df, "combined_text").collect()}
    assert set(prompts) == {1, 2}
    assert '1. A: da\n2. B: d\\"b' in prompts[1] and "t 1" in prompts[1]
    assert "1. A\n" in prompts[2]
    said = spark.createDataFrame([("1", "B, Q, B", "ok"), ("2", "NONE", "ok"), ("3", "A", "ok")], "i string, reply string, status string")
    said = said.withColumnRenamed("i", "request_id")
    rows = {r["id"]: r for r in O.verify_candidates(df, said).collect()}
    assert rows[1]["llm_verified_labels"] == ["B", "B"] and rows[1]["unknown_labels"] == ["Q"]
    assert [rows[i]["llm_verified_labels"] for i in (2, 3, 4)] == [[], [], []]


def test_reply_text(spark):
    known = {
        "hello": "hello",
        '{"choices":[{"text":"t"}]}': "t",
        '{"choices":[{"message":{"content":"m"}}]}': "m",
        '{"choices":[{"text":"t","message":{"content":"m"}}]}': "t",
        '{"other":1}': '{"other":1}',
    }
    df = spark.createDataFrame([(k,) for k in known], "r string")
    assert {r["r"]: r["o"] for r in df.select("r", O.reply_text("r").alias("o")).collect()} == known


def test_extract_fields(spark):
    df = spark.createDataFrame([("a", '{"x":["p"],"y":"q"}'), ("b", "no"), ("c", '{"choices":[{"text":"{\\"y\\":\\"z\\"}"}]}')], "request_id string, reply string")
    rows = {r["request_id"]: r for r in O.extract_fields(df, "x array<string>, y string").collect()}
    assert (rows["a"]["x"], rows["a"]["y"], rows["a"]["parsed"]) == (["p"], "q", True)
    assert (rows["b"]["x"], rows["b"]["y"], rows["b"]["parsed"]) == (None, None, False)
    assert rows["c"]["y"] == "z"


def test_patterns(spark):
    df = spark.createDataFrame([(1, "Use GitHub, v2.0 and NASA now. Use more words in this longer sentence! End.")], "id int, text string")
    row = df.select(O.mentioned_entities("text").alias("e"), O.one_line_summary("text").alias("s")).first()
    assert row["e"] == ["Use", "GitHub", "v2.0", "NASA", "End"]
    assert row["s"] == "Use more words in this longer sentence!"
    cats = df.select(O.entity_categories(O.mentioned_entities("text")).alias("c")).first()["c"]
    assert cats == {"acronym": ["NASA"], "name": ["Use", "End"], "mixed": ["GitHub", "v2.0"]}


def test_clusters_and_gaps(spark):
    rows = [(i, f"word{i % 2} shared Name{i % 2}", i % 2, ["L"] if i % 2 else []) for i in range(12)] + [(99, "  ", 7, []), (100, "x", -1, [])]
    df = spark.createDataFrame(rows, "id int, text string, cluster_id int, labels array<string>")
    themes = {r["cluster_id"]: r for r in O.cluster_themes(df, "text").collect()}
    assert themes[0]["record_count"] == 6 and themes[0]["cluster_theme"] in ("shared", "name0", "word0")
    asked = O.gap_requests(df, "text", "labels")
    prompts = {r["cluster_id"]: r["prompt"] for r in asked.collect()}
    assert set(prompts) == {0, 1}  # the blank cluster is skipped
    assert "[None]" in prompts[0] and "[L]" in prompts[1]
    found = {r["cluster_id"]: r for r in O.gap_suggestions(asked, O.pattern_gaps()(asked)).collect()}
    assert found[1]["potential_new_entities"] == ["Name1", "word1"] and found[1]["assigned_labels_in_cluster"] == ["L"]
    said = asked.select("request_id", F.lit('{"potential_new_entities":"NONE","thematic_gap_suggestions":"A: b\\n\\nC: d"}').alias("reply"), F.lit("ok").alias("status"))
    found = O.gap_suggestions(asked, said).first()
    assert found["potential_new_entities"] == [] and found["thematic_gap_suggestions"] == ["A: b", "C: d"]


def test_pages_of_a_label_list_are_not_shuffled_with_the_records(spark, tmp_path):
    import hashlib

    import registry
    from labelflow.operators.replies import CLASSIFY

    registry.load()
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    notes = [(n, f"word{n} " * 120) for n in range(20)]
    texts = [(1, "a text"), (2, None), (2, "a text"), (3, "\n\nLabels:\n1. Passage_0: no label")]
    spark.createDataFrame(notes, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, t, "en", "s") for i, t in texts], "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["M1_request_pages"](spark, str(tmp_path))
    block = md5("\n".join(f"Passage_{n}: {t}" for n, t in notes))
    want = sorted((i, block, md5(CLASSIFY.replace("{text}", t or "").replace("{labels}", "").replace("{k}", "5"))) for i, t in texts)
    assert sorted(map(tuple, got.collect())) == want
    assert "Pick the labels" not in got._jdf.queryExecution().toString()  # digests are grouped, not the prompts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        named = spark.createDataFrame([(f"L{n}", t, n) for n, t in notes], "label string, description string, pos bigint")
        asked = O.classification_requests(spark.createDataFrame(texts, "id bigint, text string"), "text", named, page_bytes=4096)
        assert "SortMergeJoin" not in asked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
