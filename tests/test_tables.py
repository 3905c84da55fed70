import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from labelflow import operators as O
from labelflow import plans as P
from labelflow import sources as S
from labelflow.settings import measure, shared_dir, written
from labelflow.streaming import label_stream, stream_records

DATED = [
    (1, "u1", "2024-01-01"), (2, "u1", "2024-02-01"), (3, "u2", None), (4, "u2", "2023-01-01"),
    (5, "u3", None), (6, "u3", None), (7, None, "2024-01-01"), (8, None, "2024-03-01"),
]


def test_dedup(spark):
    df = spark.createDataFrame(DATED, "id int, url string, d string").repartition(3)
    assert sorted(r["id"] for r in O.keep_newest(df, "url", "d").collect()) == [2, 4, 5, 8]
    assert sorted(r["id"] for r in O.keep_first(df, "url").collect()) == [1, 3, 5, 7]
    assert O.count_duplicates(df, "url").first()[0] == 4


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame(DATED, "id int, url string, d string")
    plan = O.keep_newest(df, "url", "d")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    plan = O.sample_per_group(df, "url", "id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stage_counts(spark):
    df = spark.createDataFrame(DATED, "id int, url string, d string")
    rows = O.stage_counts(df, {"url": F.col("url").isNotNull(), "date": F.col("d").isNotNull()}).collect()
    assert [tuple(r) for r in rows] == [("url", 6, 2), ("date", 5, 3)]


def test_label_counts(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, []), (4, None)], "id int, l array<string>")
    assert [tuple(r) for r in O.label_statistics(df, "l").collect()] == [("a", 2, 50.0), ("b", 1, 25.0)]
    assert tuple(O.labelled_share(df, "l").first()) == (4, 2, 50.0)
    assert tuple(O.list_totals(df, ["l"]).first()) == ("l", 3, 2, 50.0, 0.75)
    assert [tuple(r) for r in O.top_items(df, "l", 1).collect()] == [("a", 2)]
    stats = O.run_statistics(df, spark.createDataFrame([("a",), ("z",)], "label string"), "l", "r").first()
    assert tuple(stats) == (4, 2, 3, 0.75, "r")


def test_profiles(spark):
    df = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0), (3, "x", 4.0), (4, "y", None)], "id int, s string, v double")
    assert {r["column"]: r["nulls"] for r in O.null_counts(df).collect()} == {"id": 0, "s": 1, "v": 1}
    assert [tuple(r) for r in O.value_counts(df, "s").collect()] == [("x", 2), ("y", 1)]
    assert {r["column"]: r["type"] for r in O.column_info(df).collect()} == {"id": "int", "s": "string", "v": "double"}
    for limit in (10, 1):
        row = O.numeric_summary(df, ["v"], max_distinct=limit).first()
        assert (row["count"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    empty = O.numeric_summary(df.filter("v IS NULL"), ["v"], max_distinct=0).first()
    assert empty["count"] == 0 and empty["q50"] is None


def test_quantiles_of_a_hot_value(spark):
    """Equal values are one row of the sort, so no task holds the rows of a frequent value."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("v")).repartition(8)
    got = O.exact_quantiles(df, "v", [0.0, 0.2, 0.25, 0.5, 0.75, 1.0])
    want = [float(x) for x in df.toPandas()["v"].quantile([0.0, 0.2, 0.25, 0.5, 0.75, 1.0])]
    assert got == pytest.approx(want)
    assert O.exact_quantiles(df.filter("v < 0"), "v", [0.5]) == [None]
    from labelflow import settings

    stored = spark.read.parquet(f"{settings._folders[-2]}/quantiles")
    assert stored.count() == 20_001 and stored.agg(F.max("n")).first()[0] == 10_000


def test_written_tables_can_be_removed(spark):
    from labelflow.settings import remove_written

    df = written(spark.range(5), "gone")
    path = df.inputFiles()[0].removeprefix("file://")
    import os

    assert os.path.exists(path) and remove_written(spark) >= 1 and not os.path.exists(path) and remove_written(spark) == 0


def test_clusters(spark):
    df = spark.createDataFrame([(1, 0, ["b", "a"]), (2, 0, ["a"]), (3, 1, []), (4, -1, ["z"])], "id int, cluster_id int, l array<string>")
    assert {r["cluster_id"]: r["labels_text"] for r in O.cluster_labels(df, "l").collect()} == {0: "a, b", 1: "None", -1: "z"}
    assert O.cluster_count(df).first()[0] == 2
    assert [tuple(r) for r in O.cluster_sizes(df).collect()] == [(-1, 1), (0, 2), (1, 1)]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(200).withColumn("g", F.when(F.col("id") < 120, 0).otherwise(1))
    one, many = df.coalesce(1), df.repartition(7)
    pick = lambda d: sorted(r["id"] for r in d.collect())
    assert pick(O.sample_rows(one, "id", 20)) == pick(O.sample_rows(many, "id", 20))
    assert pick(O.sample_per_group(one, "g", "id", 5)) == pick(O.sample_per_group(many, "g", "id", 5))
    assert pick(O.sample_fraction(one, "id", 0.3)) == pick(O.sample_fraction(many, "id", 0.3))
    assert O.sample_rows(df, "id", 500).count() == 200
    assert pick(O.sample_rows(df, "id", 20, seed=1)) != pick(O.sample_rows(df, "id", 20, seed=2))


def test_numbering(spark):
    df = spark.range(1000).repartition(6)
    rows = O.numbered(df, [F.col("id").desc()]).collect()
    assert all(r["row_index"] == 999 - r["id"] for r in rows)
    sizes = O.with_batches(df, "id", 300).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert sorted(int(r["id"].split("_")[1]) for r in S.with_row_id(df.withColumnRenamed("id", "x"), dense=True).collect()) == list(range(1000))


def test_order(spark):
    df = spark.createDataFrame([("b", 1), (None, 2), ("a", None), ("a", 3)], "s string, v int")
    assert [tuple(r) for r in O.sort_rows(df, {"s": True, "v": False}).collect()] == [("a", 3), ("a", None), ("b", 1), (None, 2)]


# -- sources and sinks ----------------------------------------------------------------------------

RECORDS = [
    {"id": 1, "url": "u", "source": "s", "title": "<b>Hi</b>", "content": "some  text", "created_at": "2024-01-02 00:00:00+00:00",
     "metadata": {"tags": ["x"], "favorite": False}},
    {"id": 2, "url": "u", "source": "s", "title": None, "content": "older", "created_at": "2023-01-02 00:00:00+00:00", "metadata": {"tags": "x"}},
    {"id": 3, "url": "v", "source": "s", "title": "<br>", "content": " ", "created_at": "bad", "metadata": None},
    {"id": 4, "url": "w", "source": "s", "title": "", "content": "tools, &amp; more", "created_at": "bad", "metadata": None},
]


@pytest.fixture
def record_file(tmp_path):
    path = tmp_path / "records.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS) + "\nnot json\n")
    return str(path)


def test_read_records(spark, record_file):
    df = S.read_records(spark, record_file)
    rows = {r["id"]: r for r in df.collect()}
    assert json.loads(rows["1"]["metadata"]) == {"tags": ["x"], "favorite": False}
    assert rows[None]["corrupt_line"] == "not json"
    assert S.missing_columns(df) == [] and S.missing_columns(df.drop("url", "domain")) == ["url", "domain"]
    assert {r["column"] for r in S.column_report(df.drop("url")).filter("NOT present").collect()} == {"url"}
    kept, absent = S.keep_columns(df, ["title", "nope", "id"])
    assert kept.columns == ["title", "id"] and absent == ["nope"]


def test_row_ids(spark):
    df = spark.createDataFrame([("u", "t"), ("u", "t"), ("v", None)], "url string, created_at string")
    assert S.with_row_id(df).select("id").distinct().count() == 2
    assert S.with_row_id(spark.createDataFrame([(5,)], "id long")).first()["id"] == "5"
    assert S.as_records(df.drop("url")).filter("id IS NULL").count() == 0
    assert P.prepare(df.withColumn("content", F.lit("x"))).filter("id IS NULL").count() == 0


def test_prepare(spark, record_file):
    rows = P.prepare(S.read_records(spark, record_file), tag_key="tags").orderBy("id").collect()
    assert [r["id"] for r in rows] == ["1", "4"]
    assert rows[0]["combined_text"] == "Hi some text" and rows[0]["existing_tags"] == ["x"]
    assert rows[0]["created_at_dt"] == dt.datetime(2024, 1, 2) and rows[1]["created_at_dt"] is None
    assert rows[1]["combined_text"] == "tools, & more"
    assert P.prepare(S.read_records(spark, record_file)).columns[:13] == P.FLAT_COLUMNS


def test_prepare_without_optional_columns(spark):
    df = spark.createDataFrame([(1, "u", "text")], "id long, url string, content string")
    row = P.prepare(df).first()
    assert row["combined_text"] == "text" and row["existing_tags"] == [] and row["metadata"] is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, ["a", "b"], [0.5], None, dt.datetime(2024, 1, 1), 'q"x')],
        "id int, labels array<string>, label_scores array<double>, note string, at timestamp, metadata string",
    )
    S.write_csv(df, str(tmp_path / "csv"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert back.columns == ["id", "labels", "note", "at"] and back.first()["labels"] == "a, b"
    S.write_csv(df.select("id", "labels", "at", "metadata"), str(tmp_path / "flat"), skip=(), literals=True)
    lines = [r[0] for r in spark.read.text(str(tmp_path / "flat")).collect()]
    assert lines[0] == "id,labels,at,metadata"
    assert lines[1] == """1,"['a', 'b']",2024-01-01 00:00:00.000000+00:00,"q""x\""""
    S.write_json_lines(df, str(tmp_path / "json"))
    line = json.loads(spark.read.text(str(tmp_path / "json")).first()[0])
    assert line["note"] is None and line["at"].startswith("2024-01-01T00:00:00") and line["labels"] == ["a", "b"]
    stats = spark.createDataFrame([("a", 1)], "label string, count int")
    S.write_manifest(S.run_manifest(df, {"f": "p"}, "r1", stats), str(tmp_path / "m"))
    row = json.loads(spark.read.text(str(tmp_path / "m")).first()[0])
    assert row == {"run_id": "r1", "total_records": 1, "total_unique_labels": 1, "files_created": [{"name": "f", "path": "p"}]}
    vec = spark.createDataFrame([(1, [3.0, 4.0])], "id int, vector array<float>")
    for _ in range(2):
        S.write_index(vec, str(tmp_path / "ix"), "id")
    assert [tuple(r) for r in S.read_index(spark, str(tmp_path / "ix")).select("key", "norm").collect()] == [(1, 5.0)]


def test_list_literal(spark):
    lists = [["a", "it's"], [], ['say "x"', 'both\'"'], ["back\\slash", "new\nline"]]
    df = spark.createDataFrame([(x,) for x in lists], "l array<string>")
    assert [r[0] for r in df.select(S.list_literal("l")).collect()] == [str(x) for x in lists]


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    df = written(spark.range(5), "five")
    assert df.count() == 5 and shared_dir(spark) in df.inputFiles()[0]
    assert measure(df, "id")[0] == 5


# -- plans ----------------------------------------------------------------------------------------

def labels(spark):
    return spark.createDataFrame(
        [("Text", "some words", "Text", [0]), ("Tools", "tools, hammer", "Text/Tools", [0, 0])],
        "label string, description string, path string, pos array<int>",
    )


def test_enrich_flat(spark, record_file):
    out = P.enrich_flat(S.read_records(spark, record_file), labels(spark), O.overlap_provider(labels(spark)))
    assert out.columns == P.FLAT_COLUMNS + ["assigned_labels"]
    assert {r["id"]: r["assigned_labels"] for r in out.collect()} == {"1": ["Text"], "4": ["Tools"]}


def test_enrich_semantic(spark, record_file, tmp_path):
    out = P.enrich_semantic(P.prepare(S.read_records(spark, record_file)), labels(spark), 1, dim=32)
    rows = {r["id"]: r for r in out.collect()}
    assert len(rows["4"]["ontology_labels_k"]) == 1 and rows["1"]["mentioned_entities"] == ["Hi"]
    summary = P.store_semantic(out, str(tmp_path / "run"), "r").first()
    assert summary["total_records"] == 2 and len(summary["files_created"]) == 3


@pytest.mark.parametrize("expand", [True, False])
def test_enrich_verified(spark, record_file, expand):
    out, gaps = P.enrich_verified(
        S.read_records(spark, record_file), labels(spark), O.overlap_provider(labels(spark)), 2, dim=32, clusters=2,
        enforce_hierarchy=True, expand=expand,
    )
    assert out.columns == P.VERIFIED_COLUMNS
    rows = {r["id"]: r for r in out.collect()}
    assert set(rows) == {"1", "4"} and rows["4"]["final_ontology_labels"] == ["Text", "Tools"]
    assert rows["1"]["summary_and_title"] == "Hi | Summary: some text"
    if expand:
        assert gaps.columns == [*S.SUGGESTION_COLUMNS, "reply_status"] and gaps.count() >= 1
        assert all(r["cluster_id"] >= 0 for r in rows.values())
    else:
        assert gaps is None and {r["cluster_id"] for r in rows.values()} == {-1}


def test_expand_and_profile(spark):
    df = spark.createDataFrame([(i, f"topic{i % 3} words here", ["topic0"]) for i in range(30)], "id long, text string, l array<string>")
    out = P.expand(df, "text", "l", k=3, dim=32)
    assert out.clusters.count() == 30 and out.sizes.agg(F.sum("count")).first()[0] == 30
    assert "topic0" not in {r["label"] for r in out.new_labels.collect()}
    assert P.profile(df, texts=("text",), categories=("text",), ranked=("text",), n=2).top["text"].count() == 2


def test_stream_equals_batch(spark, record_file, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps(r) for r in RECORDS))
    stream = label_stream(stream_records(spark, str(folder)), labels(spark))
    query = (
        stream.select("id", "assigned_labels").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    got = {r["id"]: r["assigned_labels"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    batch = label_stream(S.read_records(spark, str(folder)), labels(spark))
    assert got == {r["id"]: r["assigned_labels"] for r in batch.select("id", "assigned_labels").collect()}
    assert got["4"] == ["Tools"]
