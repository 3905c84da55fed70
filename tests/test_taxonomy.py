import json

import pytest

from labelflow import operators as O
from labelflow import sources as S

NESTED = {
    "Zoo": {
        "description": "All animals",
        "subcategories": [
            {"Birds": {"type": "Area", "instances": [{"Owl": {"description": "Night bird"}}, {"Kiwi": None}, 5]}},
            {"Odd": [1]},
            "stray",
        ],
    },
    "Lists": [{"A": {"description": "x"}}],
    "#note": {"description": "hidden"},
    "Art": {"subcategories": {"no": "list"}},
}


def docs(spark, *bodies):
    return spark.createDataFrame([(str(n), json.dumps(b)) for n, b in enumerate(bodies)], "doc string, body string")


def test_three_levels(spark):
    rows = O.flatten_taxonomy(docs(spark, NESTED)).orderBy("pos").collect()
    assert [(r["label"], r["description"], r["path"], r["level"], r["parent_path"]) for r in rows] == [
        ("Zoo", "All animals", "Zoo", 1, None),
        ("Birds", "Subcategory: Birds", "Zoo/Birds", 2, "Zoo"),
        ("Owl", "Night bird", "Zoo/Birds/Owl", 3, "Zoo/Birds"),
        ("Kiwi", "Instance: Kiwi", "Zoo/Birds/Kiwi", 3, "Zoo/Birds"),
        ("Art", "Domain: Art", "Art", 1, None),
    ]


def test_problems(spark):
    got = {(r["path"], r["problem"]) for r in O.taxonomy_problems(docs(spark, NESTED)).collect()}
    assert got == {
        ("Lists", "domain is no map"), ("Zoo", "subcategories item is no map"), ("Zoo/Odd", "subcategory is no map"),
        ("Zoo/Birds", "instances item is no map"), ("Art", "subcategories is no list"),
    }


def test_top_level(spark):
    rows = O.top_level_labels(docs(spark, NESTED)).collect()
    assert [(r["label"], r["description"]) for r in rows] == [("Zoo", "All animals")]


def test_generic(spark):
    body = {
        "Big Cats": {"description": "Cats", "size": "large", "kinds": ["Lion", {"name": "Snow Leopard", "home": {"description": "Hills"}}]},
        "text": "free",
        "instances": ["left out"],
    }
    rows = O.flatten_generic(docs(spark, body, [{"X": {}}])).orderBy("doc", "pos").collect()
    assert [(r["label"], r["description"], r["path"]) for r in rows] == [
        ("Big Cats", "Cats", "Big_Cats"),
        ("size", "large", "Big_Cats/size"),
        ("Lion", "Lion, part of kinds", "Big_Cats/kinds/Lion"),
        ("Snow Leopard", "No description available", "Big_Cats/kinds/Snow_Leopard"),
        ("home", "Hills", "Big_Cats/kinds/Snow_Leopard/home"),
        ("text", "free", "text"),
        ("X", "No description", "list_item_0/X"),
    ]


def test_generic_loses_subcategories(spark):
    nested = {"Zoo": {"description": "d", "subcategories": [{"Birds": {"description": "b"}}]}}
    assert [r["label"] for r in O.flatten_generic(docs(spark, nested)).collect()] == ["Zoo"]


def test_read_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(NESTED))
    (tmp_path / "b.json").write_text('{"Sea": {"description": "Water"}}')
    assert O.flatten_taxonomy(S.read_taxonomy(spark, str(tmp_path))).count() == 6


def test_read_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "t.yaml").write_text(
        "Zoo:\n  description: All, with commas\n  subcategories:\n    - Birds:\n        instances:\n          - Owl: { description: Night, bird }\n"
    )
    rows = O.flatten_taxonomy(S.read_taxonomy(spark, str(tmp_path), "yaml")).orderBy("pos").collect()
    # a flow map ends a value at the comma
    assert [r["description"] for r in rows] == ["All, with commas", "Subcategory: Birds", "Night"]


def test_label_table(spark):
    labels = spark.createDataFrame(
        [("A", "A", [0]), ("B", "A/B", [0, 0]), ("B", "C/B", [1, 0]), ("C", "C", [1]), ("D", "A/B/D", [0, 0, 0])],
        "label string, path string, pos array<int>",
    )
    assert {(r["label"], r["path"]) for r in O.first_by_label(labels).collect()} == {("A", "A"), ("B", "A/B"), ("C", "C"), ("D", "A/B/D")}
    assert [tuple(r) for r in O.repeated_labels(labels).collect()] == [("B", 2)]
    assert {r["label"] for r in O.root_labels(labels).collect()} == {"A", "C"}
    assert O.distinct_labels(labels).count() == 4
    assert {r["label"]: r["parents"] for r in O.closure_table(labels).collect()} == {"B": ["A", "C"], "D": ["A", "B"]}
    paths = O.label_paths(spark.createDataFrame([(1, "B"), (2, "Z")], "id int, label string"), labels)
    assert {r["label"]: r["path"] for r in paths.collect()} == {"B": "C/B", "Z": None}


BROKEN = ['{"Zoo": ', "[1, 2]", "", "3", '{"A": {"subcategories": [{"B": {"description": 5, "instances": [{"C": true}]}}]}}', '{"list": [{"name": 3, "description": null}, {"name": null}]}']


def test_documents_that_fail_are_reported(spark):
    df = spark.createDataFrame([*((str(i), b) for i, b in enumerate(BROKEN)), ("none", None)], "doc string, body string")
    labels = {(r["doc"], r["path"], r["description"]) for r in O.flatten_taxonomy(df).collect()}
    assert labels == {("4", "A", "Domain: A"), ("4", "A/B", "5"), ("4", "A/B/C", "Instance: C")}
    problems = {(r["doc"], r["path"], r["problem"]) for r in O.taxonomy_problems(df).collect()}
    assert problems == {
        ("0", "", "document does not parse"), ("1", "", "root is no map"), ("2", "", "document does not parse"), ("3", "", "root is no map"),
        ("5", "list", "domain is no map"), ("none", "", "document does not parse"),
    }
    assert {(r["doc"], r["label"], r["description"], r["path"]) for r in O.flatten_generic(df).filter("doc <> '4'").collect()} == {("5", "3", None, "list/3")}
    assert {r["doc"] for r in O.generic_problems(df).collect()} == {"0", "2", "none"}
    deep = spark.createDataFrame([("d", "[" * 5000 + "]" * 5000), ("e", '{"a": ' * 900 + "1" + "}" * 900)], "doc string, body string")
    assert O.flatten_taxonomy(deep).filter("doc = 'd'").count() == 0 and O.flatten_generic(deep).filter("doc = 'd'").count() == 0


def test_one_scan_and_one_walk(spark, tmp_path, capsys):
    (tmp_path / "a.json").write_text(json.dumps(NESTED))
    O.flatten_taxonomy(S.read_taxonomy(spark, str(tmp_path))).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and "Generate" not in plan


def test_one_bad_yaml_file_fails_no_job(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "a.yaml").write_text("Zoo: [unclosed")
    (tmp_path / "b.yaml").write_text("Sea:\n  description: Water\n")
    docs = S.read_taxonomy(spark, str(tmp_path), "yaml")
    assert [r["label"] for r in O.flatten_taxonomy(docs).collect()] == ["Sea"]
    assert [r["problem"] for r in O.taxonomy_problems(docs).collect()] == ["document does not parse"]
