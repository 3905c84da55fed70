import random
import re

from pyspark.sql import functions as F

from labelflow.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Maximal conversations by comparing lists of turns."""
    convs = {}
    for c, t, r, x in sorted(set(rows), key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")):
        convs.setdefault(c, []).append((r, x))
    first = {}
    for c in sorted(convs, key=lambda c: (c is None, c)):
        first.setdefault(tuple(convs[c]), []).append(c)
    begun = {turns[:k] for turns in first for k in range(1, len(turns))}
    text = lambda turns: "".join(f"<|{r or ''}|>\n{(x or '').replace('<|', '< |')}<|end|>\n" for r, x in turns)
    return sorted(((str(c[0]), len(turns), len(c), text(turns)) for turns, c in first.items() if turns not in begun))


def made(rng):
    rows, conv = [], 0
    for _ in range(60):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(["hi", "ok", "", None, "<|user|>x", f"t{rng.randint(0, 9)}"])) for _ in range(rng.randint(1, 9))]
        for k in sorted({rng.randint(1, len(turns)) for _ in range(3)} | {len(turns)}):
            rows += [(conv, i, *t) for i, t in enumerate(turns[:k])]
            conv += 1
    return rows


def got(df, **options):
    out = chat.format_chats(df, **options)
    assert out.columns == ["conv_id", "n_turns", "copies", "part", "chat"]
    parts = {}
    for r in sorted(out.collect(), key=lambda r: r["part"]):
        parts.setdefault((str(r["conv_id"]), r["n_turns"], r["copies"]), []).append(r["chat"])
    return sorted((*k, "".join(v)) for k, v in parts.items()), parts


def test_snapshots_collapse_by_brute_force(spark):
    rows = made(random.Random(10))
    df = spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("mine"))
    want = plain(rows)
    assert got(df)[0] == want
    assert got(df.unionByName(df).repartition(7))[0] == want  # repeated rows change nothing
    found, parts = got(df, part_turns=2)
    assert found == want and max(map(len, parts.values())) == 5


def test_nulls_shared_first_turns_and_empty_tables(spark):
    rows = [(None, 0, "user", "a"), (None, None, "user", "b"), (1, 0, "user", "hello"), (2, 0, "user", "hello"), (2, 1, "assistant", "yes")]
    rows += [(c, t, "user", "hello" if t == 0 else f"{c} {t}") for c in range(10, 200) for t in range(2)]
    df = spark.createDataFrame(rows, TURNS)
    found = got(df)[0]
    assert len(found) == 192 and not any(f[0] == "1" for f in found)
    assert [f for f in found if f[0] == "None"] == [("None", 2, 1, "<|user|>\nb<|end|>\n<|user|>\na<|end|>\n")]
    assert chat.format_chats(df.limit(0)).count() == 0


def test_one_long_conversation_is_spread_and_rendered_in_parts(spark):
    rows = [(5, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(2500)] + [(6, t, "user" if t % 2 == 0 else "assistant", f"turn {t}") for t in range(1200)]
    df = spark.createDataFrame(rows, TURNS)
    found, parts = got(df)
    assert found == plain(rows) and [len(v) for v in parts.values()] == [3]


def test_no_python_in_the_plan(spark, capsys):
    chat.format_chats(spark.range(4).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))).explain()
    assert not re.search("Python|ArrowEval|Pandas", capsys.readouterr().out)


def test_the_sql_cuts_long_conversations_in_the_same_places(spark, tmp_path):
    import duckdb

    rows = [(1, i, "user", f"turn {i}") for i in range(2500)] + [(2, i, "user", f"turn {i}") for i in range(1000)] + [(3, 0, "user", "x" * 500_000)]
    df = spark.createDataFrame(rows, TURNS)
    df.write.parquet(str(tmp_path / "c"))
    db = duckdb.connect()
    db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    want = sorted(db.sql(f"SELECT conv_id, n_turns, copies, part, chat FROM ({chat.CHAT_SQL})").fetchall())
    assert sorted(tuple(r) for r in chat.format_chats(df).collect()) == want
    assert [(w[0], w[3]) for w in want] == [(1, 0), (1, 1), (1, 2), (3, 0)]
