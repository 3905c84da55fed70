import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelflow import functions as L
from labelflow.functions.markup import visible_text

CLEAN = [
    (None, ""),
    ("", ""),
    ("  \n ", ""),
    ("<p>A &amp; B</p>\n<b>C</b>", "A & B C"),
    ("a<br>b", "ab"),
    ('<style>p{}</style><script>var t="</p>";</script>hi<!-- ad -->', "hi"),
    ("café&nbsp; bar", "café bar"),
    ("1 < 2 & 3", "1 < 2 & 3"),
    ("x &amp;lt;y&amp;gt; z", "x <y> z"),
    ("a\x1cb\x85c", "a b c"),
]


def values(df, column="o"):
    return [r[column] for r in df.orderBy("n").collect()]


def frame(spark, items, kind="string"):
    return spark.createDataFrame([(n, x) for n, x in enumerate(items)], f"n int, x {kind}")


@pytest.mark.parametrize("mode", ["parser", "sql"])
@pytest.mark.parametrize("once", [False, True])
def test_clean_text(spark, mode, once):
    df = frame(spark, [c[0] for c in CLEAN])
    assert values(df.select("n", L.clean_text("x", mode, once).alias("o"))) == [c[1] for c in CLEAN]


def test_clean_text_flagged(spark):
    df = frame(spark, ["<b>x</b>", "plain  text", None, "<![odd"])
    got = values(df.select("n", L.clean_text_flagged("x").alias("o")))
    assert [g["text"] for g in got][:3] == ["x", "plain text", ""]
    assert [g["failed"] for g in got][:3] == [False, False, False]
    # the odd one is either read or flagged, and never NULL
    assert got[3]["text"] is not None and got[3]["failed"] == (got[3]["text"] == "")


def test_unknown_mode():
    with pytest.raises(ValueError):
        L.clean_text("x", "other")


piece = st.one_of(
    st.text(alphabet="ab é\n;#x1", max_size=6),
    st.sampled_from(["<p>", "</p>", "<br/>", "<!-- c -->", "&amp;", "&lt;", "&quot;", '<a href="u?x=1">', "<script>if(a<b){}</script>"]),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(piece, max_size=8).map("".join), min_size=1, max_size=40))
def test_sql_mode_agrees_on_plain_markup(spark, docs):
    docs = [d for d in docs if "&" not in d.replace("&amp;", "").replace("&lt;", "").replace("&quot;", "")]
    docs = [d for d in docs if "&amp;" not in d or "&amp;&" not in d]
    docs = [d for d in docs if not any(f"&amp;{c}" in d for c in "abéx#1;<&")]
    if not docs:
        return
    rows = frame(spark, docs).select("n", L.clean_text("x", "sql").alias("o"))
    assert values(rows) == [visible_text(d) for d in docs]


def test_filter_runs_parser_once(spark):
    df = frame(spark, ["<b>x</b>"]).select(L.clean_text("x", once=True).alias("o")).filter("o <> ''")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_parse_time(spark):
    df = frame(spark, ["2024-10-16 10:51:33.057000+00:00", "2024-10-16T10:51:33.056Z", "nope", "2024-13-01", None])
    assert values(df.select("n", L.parse_time("x").alias("o"))) == [
        dt.datetime(2024, 10, 16, 10, 51, 33, 57000), dt.datetime(2024, 10, 16, 10, 51, 33, 56000), None, None, None,
    ]


def test_escape_prompt(spark):
    df = frame(spark, ['a\\b "q"\r\nz', None])
    assert values(df.select("n", L.escape_prompt("x").alias("o"))) == ['a\\\\b \\"q\\" z', ""]


def test_name_terms(spark):
    known = {
        "GitHub": ["git", "hub"], "LlamaIndex": ["llama", "index"], "DSPy": ["ds", "py"], "OpenAI_API": ["open", "ai", "api"],
        "v0": ["v0"], "XML-CNN": ["xm", "cnn"], "Wiki10-31K": ["wiki", "k"], "JMBFLOORS": ["jmbfloors"], "a  b": ["a", "b"],
    }
    df = frame(spark, list(known))
    assert values(df.select("n", L.name_terms("x").alias("o"))) == list(known.values())


def test_description_terms(spark):
    df = frame(spark, ["Concepts, tools, and more for building software.", None])
    assert values(df.select("n", L.description_terms("x").alias("o"))) == [
        ["concepts,", "tools,", "more", "building", "software."], [],
    ]
    assert values(df.select("n", L.description_terms("x", strip_punct=True).alias("o")))[0] == [
        "concepts", "tools", "more", "building", "software",
    ]


def test_ancestor_paths(spark):
    df = frame(spark, ["A", "A/B", "A/B/C"])
    assert values(df.select("n", L.ancestor_paths("x").alias("o"))) == [[], ["A"], ["A", "A/B"]]


def test_tags(spark):
    df = frame(spark, ['{"tags":["a","b"]}', '{"tags":"a"}', '["tags"]', "not json", None, '{"raindrop_tags":["r"]}'])
    assert values(df.select("n", L.extract_tags("x", "tags").alias("o"))) == [["a", "b"], [], [], [], [], []]
    assert values(df.select("n", L.extract_tags("x").alias("o")))[-1] == ["r"]
    as_variant = df.select("n", F.try_parse_json("x").alias("x"))
    assert values(as_variant.select("n", L.extract_tags("x", "tags", "variant").alias("o")))[0] == ["a", "b"]
    as_map = frame(spark, [{"tags": ["a"]}, {}], "map<string,array<string>>")
    assert values(as_map.select("n", L.extract_tags("x", "tags", "map").alias("o"))) == [["a"], []]


def test_items_and_none(spark):
    df = frame(spark, [" a, ,b ,", "NONE", " none\n", "nonesuch", None])
    assert values(df.select("n", L.split_items("x").alias("o")))[0] == ["a", "b"]
    assert values(df.select("n", L.split_items("x", keep_empty=True).alias("o")))[0] == ["a", "", "b", ""]
    assert values(df.select("n", L.is_none_reply("x").alias("o"))) == [False, True, True, False, None]


def test_small_functions(spark):
    df = frame(spark, ["abcdef", None])
    assert values(df.select("n", L.preview("x", 3).alias("o"))) == ["abc...", None]
    assert values(df.select("n", L.text_length("x").alias("o"))) == [6, 0]
    assert values(df.select("n", L.combine_text("x", F.lit(None)).alias("o"))) == ["abcdef", ""]
    assert values(df.select("n", L.combine_text(F.lit(""), "x", trim=False).alias("o"))) == [" abcdef", " "]
    assert values(df.select("n", L.summary_text("x", F.lit("s")).alias("o"))) == ["abcdef | Summary: s", " | Summary: s"]
    assert values(df.select("n", L.label_plus_desc(F.lit("l"), "x").alias("o"))) == ["l: abcdef", "l: No description"]
    assert values(df.select("n", L.percentage(F.lit(1), F.lit(3)).alias("o"))) == [33.33, 33.33]
    assert values(df.select("n", L.percentage(F.lit(1), F.lit(0)).alias("o"))) == [None, None]
