"""Work that must not be done twice, and what a task or a worker holds."""

import pyarrow as pa
import pytest

from labelflow import operators as O
from labelflow.operators import keywords


def counted(spark, rows, schema):
    """A table and the accumulator that tells how many of its rows were made."""
    made = spark.sparkContext.accumulator(0)

    def tell(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    return spark.createDataFrame(rows, schema).mapInArrow(tell, schema), made


LISTS = [(["a", "b"],), (["b", None, "b"],), ([],), (None,)]


def test_label_statistics_make_their_rows_once(spark):
    df, made = counted(spark, LISTS, "l array<string>")
    got = [tuple(r) for r in O.label_statistics(df, "l").collect()]
    assert got == [("b", 3, 75.0), (None, 1, 25.0), ("a", 1, 25.0)] and made.value == len(LISTS)


@pytest.mark.parametrize("least", [1, 2])
def test_label_pairs_make_their_rows_once(spark, least):
    df, made = counted(spark, LISTS + [(["b", "a"],)], "l array<string>")
    got = [tuple(r) for r in O.label_pairs(df, "l", least).collect()]
    assert got == [("a", "b", 2, 2, 3, 1.666667)] and made.value == 5


def test_lists_of_orders_take_more_tasks_as_lines_grow(spark, tmp_path, monkeypatch):
    import registry
    from registry import derived

    tables = {
        "lineitem": ([(i % 50, i % 3) for i in range(100)] + [(None, 1), (7, None)], "l_orderkey long, l_suppkey long"),
        "orders": ([(i, i % 2) for i in range(50)] + [(7, 1), (None, 1)], "o_orderkey long, o_custkey long"),
        "supplier": ([(i, f"S{i}") for i in range(2)], "s_suppkey long, s_name string"),
        "customer": ([(0, 0), (1, 1)], "c_custkey long, c_nationkey int"),
        "nation": ([(0, "X"), (1, "Y")], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(derived, "TASK_LINES", 10)
    lists = derived.order_labels(registry.Tables(spark, str(tmp_path)))
    want = {}
    for order, supplier in tables["lineitem"][0]:
        if order is not None and supplier in (0, 1):
            want.setdefault(order, set()).add(f"S{supplier}")
    want = {i: [*sorted(s), "Y" if i == 7 or i % 2 else "X"] for i, s in want.items()}
    assert {r["id"]: r["labels"] for r in lists.collect()} == want
    assert lists.rdd.getNumPartitions() >= 11


def test_terms_of_many_labels_are_looked_for_once(spark):
    labels = spark.createDataFrame([(f"{a} {b}", "", 9 * i + j) for i, a in enumerate("pqr") for j, b in enumerate(["ab", "cd", "ef"])] * 4, "label string, description string, pos int")
    df = spark.createDataFrame([(0, "ab, ab"), (1, "abc q"), (2, None), (3, "")], "id int, text string")
    got = O.match_keywords(df, "text", labels, 3, out="o", word_match=True, form="inline")
    assert sorted((r["id"], r["o"]) for r in got.collect()) == [(0, ["p ab"] * 3), (1, ["q ab"] * 3), (2, []), (3, [])]
    assert "arrays_overlap" in got._jdf.queryExecution().toString()


def test_a_text_is_searched_by_its_distinct_words(spark):
    df = spark.createDataFrame([("a\tb  a\nb\x1cc",), (None,)], "text string")
    assert [r[0] for r in df.select(keywords._text_words(df["text"])).collect()] == [["a", "b", "b\x1cc"], None]


def test_texts_are_looked_up_in_bounded_runs(monkeypatch):
    monkeypatch.setattr(keywords, "RUN_WORDS", 4)
    lists = pa.array([["a"] * 3, None, ["b"], ["c"] * 9, [], ["d"]], pa.list_(pa.string()))
    runs = list(keywords._text_runs(lists))
    assert pa.concat_arrays(runs).equals(lists) and [len(r) for r in runs] == [3, 1, 2]
    assert [len(r) for r in keywords._text_runs(lists[:0])] == [0]


def test_full_texts_are_not_read_for_further_blocks(spark, monkeypatch):
    kept, write = [], keywords.written

    def told(df, name):
        out = write(df, name)
        kept.append(out.count())
        return out

    monkeypatch.setattr(keywords, "written", told)
    labels = spark.createDataFrame([(f"Name{n}", "abcdefgh"[n] * 4, n) for n in range(8)], "label string, description string, pos int")
    df = spark.createDataFrame([(0, "aaaa bbbb cccc"), (1, "hhhh"), (2, None), (3, "bbbb aaaa")], "id int, text string")
    spark.conf.set("spark.labelflow.broadcastBytes", "40")
    try:
        out = O.match_keywords(df, "text", labels, 2, out="o", form="blocks")
        assert sorted((r["id"], r["o"]) for r in out.collect()) == [(0, ["Name0", "Name1"]), (1, ["Name7"]), (2, []), (3, ["Name0", "Name1"])]
    finally:
        spark.conf.unset("spark.labelflow.broadcastBytes")
    assert kept[0] == 3 and kept[-1] == 1
