"""Chat formatting in DataFrame functions only: collapse of cumulative snapshots, then rendering.

A conversation that was logged after every turn leaves snapshots, each the beginning of the next. A
rolling hash of every turn prefix tells which conversations begin longer ones; an anti-join keeps the
others, of equal ones that with the smallest id, and these are rendered.

Turns are dealt by ranges of (conversation, turn), so one very long conversation spreads over many
tasks: positions and rolling hashes are made per range and then shifted by what the ranges before
it hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import join_unique, join_unique_parts
from ..settings import written

PART_TURNS = 1000


def _hash(seed: int, *columns: Column) -> Column:
    """64-bit hash that tells null from the empty text and one column from the next."""
    parts = [x for c in columns for x in (c.isNull(), F.coalesce(c.cast("string"), F.lit("")))]
    return F.xxhash64(F.lit(seed), *parts)


def _shift(rows: DataFrame, total: Column, name: str) -> DataFrame:
    """For every conversation and range, ``name``: ``total`` over the ranges before it."""
    sums = rows.groupBy("conv", "range").agg(total.alias("_sum"), F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    if name == "offset":
        return sums.select("conv", "range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(name), "size")
    shift = F.struct(*(F.coalesce(F.bit_xor(F.col(f"_sum.{h}")).over(before), F.lit(0)).alias(h) for h in ("p1", "p2")))
    return sums.select("conv", "range", shift.alias(name), "size")


def turn_prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct turn: ``conv`` (text key of the conversation), its id, the row's hashes
    ``r1, r2``, its position ``pos`` from 1, and the rolling hash ``p1, p2`` of the turns up to it.

    Turns are ordered by turn number (null first), then role and hash of the text; a turn logged
    twice with equal values is one turn. Rows without a conversation id form one conversation.
    """
    c, t, r, x = (F.col(f"`{n}`") for n in (conv, turn, role, text))
    key = F.when(c.isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), c.cast("string")))
    rows = turns.select(
        key.alias("conv"), c.alias("id"), t.alias("turn"), r.cast("string").alias("role"), _hash(1, t, r, x).alias("r1"), _hash(2, t, r, x).alias("r2"),
        _hash(3, r, x).alias("m1"), _hash(4, r, x).alias("m2")).distinct()
    order = ["conv", F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), "r1", "r2"]
    ranged = rows.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ranged = written(ranged, "turns")
    local = Window.partitionBy("conv", "range").orderBy(*order[1:])
    numbered = ranged.withColumn("pos", F.row_number().over(local).cast("bigint"))
    numbered = numbered.join(_shift(ranged, F.count(F.lit(1)), "offset"), ["conv", "range"]).withColumn("pos", F.col("pos") + F.col("offset"))
    hashed = numbered.withColumns({"h1": F.xxhash64("pos", "m1"), "h2": F.xxhash64("pos", "m2", F.lit(7))}).drop("offset", "size", "m1", "m2")
    hashed = written(hashed, "positions")
    so_far = Window.partitionBy("conv", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rolled = hashed.withColumns({f"p{k}": F.bit_xor(f"h{k}").over(so_far) for k in (1, 2)})
    totals = F.struct(F.bit_xor("h1").alias("p1"), F.bit_xor("h2").alias("p2"))
    rolled = rolled.join(_shift(hashed, totals, "shift"), ["conv", "range"])
    shifted = {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"shift.p{k}")) for k in (1, 2)}
    return rolled.withColumns(shifted).select("conv", "id", "r1", "r2", "pos", "p1", "p2")


def maximal(prefixes: DataFrame) -> DataFrame:
    """The conversations that begin no longer one: ``conv``, ``n_turns`` and ``copies``, the number of
    equal conversations, of which the first by id stands for all."""
    sizes = prefixes.groupBy("conv").agg(F.max("pos").alias("n_turns"), F.count(F.lit(1)).alias("rows"))
    sized = join_unique(prefixes, sizes, "conv", "rows", prefixes.count())
    ends = sized.filter("pos = n_turns").groupBy("pos", "p1", "p2").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "conv")).alias("first"), F.count(F.lit(1)).alias("copies"))
    begun = sized.filter("pos < n_turns").select("pos", "p1", "p2").distinct()
    return ends.join(begun, ["pos", "p1", "p2"], "left_anti").select(F.col("first.conv").alias("conv"), F.col("pos").alias("n_turns"), "copies")


def render(role: Column, text: Column) -> Column:
    """One turn in the chat template; a marker inside the text is broken up, so that it opens no turn."""
    safe = F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), safe, F.lit("<|end|>\n"))


def format_chats(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_turns: int = PART_TURNS,
) -> DataFrame:
    """The maximal conversations: id, ``n_turns``, ``copies``, ``part`` from 0, ``chat``. A conversation
    of up to ``part_turns`` turns is one row; a longer one has a row for each so many turns, so no row
    gathers more. Null roles and texts render as empty; extra columns are left out; an empty table
    gives an empty result."""
    prefixes = written(turn_prefixes(turns, conv, turn, role, text), "prefixes")
    kept = written(maximal(prefixes), "maximal")
    t, r, x = (F.col(f"`{n}`") for n in (turn, role, text))
    c = F.col(f"`{conv}`")
    key = F.when(c.isNull(), F.lit("none")).otherwise(F.concat(F.lit("id "), c.cast("string")))
    rows = turns.select(
        key.alias("conv"), c.alias("id"), t.alias("turn"), r.cast("string").alias("role"), _hash(1, t, r, x).alias("r1"), _hash(2, t, r, x).alias("r2"),
        render(r.cast("string"), x.cast("string")).alias("said"))

    # conversations of one part: gathered by the key they are joined on, in the order that gave the positions
    counts = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("rows"))
    # a shuffled join keeps the partitioning for the gathering; a broadcast one would shuffle the texts again
    short = kept.filter(F.col("n_turns") <= part_turns).join(counts, "conv").hint("merge")
    turn_order = F.struct("turn", "role", "r1", "r2", "said")  # nulls first in each
    parts = [_gathered(side, F.lit(0), turn_order) for side in join_unique_parts(rows, short, "conv", "rows", rows.count())]

    # longer ones, if there are any: every turn is given its position, and they are gathered part by part
    long = kept.filter(F.col("n_turns") > part_turns).withColumn("rows", F.col("n_turns"))
    if not long.isEmpty():
        places = join_unique(prefixes.drop("p1", "p2", "id"), long, "conv", "rows", prefixes.count())
        said = rows.join(places, ["conv", "r1", "r2"])  # the hashes tell all distinct turns of a conversation apart
        parts.append(_gathered(said, F.floor((F.col("pos") - 1) / part_turns), F.struct("pos", "said")))
    whole = reduce(DataFrame.unionByName, parts)
    return whole.select(F.col("id").alias(conv), "n_turns", "copies", "part", "chat")


def _gathered(said: DataFrame, part: Column, order: Column) -> DataFrame:
    """One row per conversation and part, with its turns in order; repeated turns are one."""
    by = ["conv"] if "pos" not in said.columns else ["conv", part.cast("bigint").alias("part")]
    parts = said.groupBy(*by).agg(
        F.first("id").alias("id"), F.first("n_turns").alias("n_turns"), F.first("copies").alias("copies"),
        F.array_sort(F.collect_set(order)).alias("turns"))
    chat = F.array_join(F.transform("turns", lambda s: s["said"]), "")
    return parts.withColumn("part", F.col("part") if len(by) > 1 else part.cast("bigint")).withColumn("chat", chat).drop("turns")


# The same for DuckDB, by comparing whole lists of turns instead of hashes.
CHAT_SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn, role, text) AS l FROM t GROUP BY conv_id),
u AS (SELECT l, min(conv_id) AS conv_id, count(*) AS copies FROM c GROUP BY l),
p AS (SELECT DISTINCT l[1:k] AS l FROM (SELECT l, unnest(generate_series(1, len(l) - 1)) AS k FROM u))
SELECT conv_id, CAST(len(l) AS BIGINT) AS n_turns, copies, CAST(part AS BIGINT) AS part,
       list_reduce(list_transform(l[part * PART + 1:(part + 1) * PART], lambda s: '<|' || coalesce(s.role, '') || '|>' || chr(10)
                                  || replace(coalesce(s.text, ''), '<|', '< |') || '<|end|>' || chr(10)), lambda a, b: a || b) AS chat
FROM (SELECT *, unnest(generate_series(0, (len(l) - 1) // PART)) AS part FROM u WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.l = u.l))
""".replace("PART", str(PART_TURNS))
