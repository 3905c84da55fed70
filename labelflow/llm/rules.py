"""Quality rules in DataFrame functions only: lines first, then documents.

Every line is judged by itself; lines that fail are removed, and a document that loses too much of
its text with them is rejected, as is one that fails the base rules (too few words, too many words
in repeated windows). All per row: no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import free_name

BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
PUNCTUATION = r"[^\p{L}\p{M}\p{N}\x20\x09-\x0D]"
SEPARATOR = r"[|»›•·]"
ENDS = r"[.!?…。！？:;][\"'”’»)\]]*[\x20\x09-\x0D]*$"
# Accented letters are given in all forms, as (?i) folds plain letters only; no phrase ends in one.
BOILERPLATE = (
    r"(?i)\b(all rights reserved|cookie policy|privacy policy|terms of (use|service)|enable javascript|"
    r"sign (in|up)|log ?in|subscribe (now|to)|click here|share (this|on)|skip to (main )?content|lorem ipsum|"
    r"alle rechte vorbehalten|datenschutzerkl[aäÄ]rung|nutzungsbedingungen|hier klicken|jetzt (anmelden|abonnieren)|zum inhalt springen|"
    r"tous droits r[eéÉ]serv[eéÉ]s|mentions l[eéÉ]gales|politique de (confidentialit\S*|cookies)|conditions d['’]utilisation|"
    r"cliquez ici|abonnez-vous|aller au contenu|"
    r"todos los derechos reservados|aviso legal|pol[iíÍ]tica de (privacidad|cookies)|condiciones de uso|ha(ga|z) clic|"
    r"inicia(r)? sesi[oóÓ]n|suscr[iíÍ]bete|saltar al contenido)\b"
)
DEFAULTS = {
    "min_words": 10,  # base rules
    "max_repeat_percent": 20,
    "max_punctuation_percent": 20,  # of a line's characters, from min_line_words words on
    "min_separators": 3,  # a navigation line has so many, and one for every four words
    "min_line_words": 5,  # a shorter line must end like a sentence
    "max_boilerplate_words": 12,
    "max_lost_percent": 30,  # of a document's word characters
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; written out, a lambda would compute it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS, -1), "")


def covered_words(words: Column, size: int = 5) -> Column:
    """How many words lie in windows of ``size`` words that occur twice or more in the list."""

    def positions(ranked: Column) -> Column:
        def repeated(x: Column, k: Column) -> Column:
            same = [F.get(ranked, k + step)["h"] == x["h"] for step in (-1, 1)]
            return F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False))

        return F.array_sort(F.transform(F.filter(ranked, repeated), lambda x: x["i"]))

    def span(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(size), F.coalesce(F.get(at, k + 1) - p, F.lit(size))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def count(h: Column) -> Column:
        ranked = F.array_sort(F.transform(h, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
        some = let(let(ranked, positions), span)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("bigint")).otherwise(some)

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - size)
        return F.transform(starts, lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(size))))

    short = F.size(words) <= size
    hashes = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), count))
    return F.when(short, F.lit(0).cast("bigint")).otherwise(hashes)


def line_passes(line: Column, limits: dict[str, int]) -> Column:
    """The line rules; a line without words passes, as it holds no text."""
    words = F.regexp_count(line, F.lit(WORD))
    marks = F.regexp_count(line, F.lit(PUNCTUATION))
    chars = F.char_length(F.regexp_replace(line, BLANKS, ""))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    least = F.lit(limits["min_line_words"])

    def judge(x: Column) -> Column:
        punctuated = (x["words"] >= least) & (x["marks"] * 100 > x["chars"] * limits["max_punctuation_percent"])
        stub = (x["words"] > 0) & (x["words"] < least) & ~line.rlike(ENDS)
        navigation = (x["separators"] >= limits["min_separators"]) & (x["separators"] * 4 >= x["words"])
        boiler = (x["words"] <= limits["max_boilerplate_words"]) & line.rlike(BOILERPLATE)
        return ~(punctuated | stub | navigation | boiler)

    counts = F.struct(words.alias("words"), marks.alias("marks"), chars.alias("chars"), separators.alias("separators"))
    return let(counts, judge)


def quality_rules(df: DataFrame, text: str = "text", **limits: int) -> DataFrame:
    """The columns of ``df`` and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (long), ``base_failed``, ``clean_text`` (the lines that pass), ``lost_chars`` (word characters in
    the others) and ``kept``. Columns of these names are replaced.

    Null counts as the empty text: no words, base failed, not kept. Rows are judged one by one, so
    repeated rows get equal results and an empty table an empty one.
    """
    p = DEFAULTS | limits
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    lines = F.split(whole, "\n", -1)
    spare = free_name("_words", df.columns)
    counted = F.filter(lines, lambda x: x.rlike(WORD))
    passed = F.array_join(F.filter(lines, lambda x: line_passes(x, p)), "\n")
    chars = lambda t: F.char_length(F.regexp_replace(t, BLANKS, "")).cast("bigint")
    out = df.withColumns({
        "word_chars": chars(whole),
        "n_symbols": F.regexp_count(whole, F.lit(SYMBOL)).cast("bigint"),
        "n_dup_lines": let(counted, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
        spare: let(words_of(whole), lambda w: F.struct(F.size(w).alias("n"), covered_words(w).alias("repeated"))),
        "clean_text": passed,
    })
    out = out.withColumns({
        "n_words": F.col(spare)["n"].cast("bigint"), "n_repeat_words": F.col(spare)["repeated"],
        "lost_chars": F.col("word_chars") - chars(F.col("clean_text")),
    }).drop(spare)
    base = (F.col("n_words") < p["min_words"]) | (F.col("n_repeat_words") * 100 > F.col("n_words") * p["max_repeat_percent"])
    out = out.withColumn("base_failed", base)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") * 100 <= F.col("word_chars") * p["max_lost_percent"]))


def keep_good(docs: DataFrame, text: str = "text", **limits: int) -> DataFrame:
    """The documents that pass, with the columns of ``docs``; failed lines are gone from their text,
    and ``n_chars``, if there is such a column, counts the text that is left."""
    judged = quality_rules(docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text")), "_text", **limits)
    changed = {text: F.when(F.col("lost_chars") > 0, F.col("clean_text")).otherwise(F.col("_text"))}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("lost_chars") > 0, F.char_length("clean_text").cast(kind)).otherwise(F.col("_row.n_chars"))
    columns = [changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns]
    return judged.filter("kept").select(*columns)


# The same rules for DuckDB, written for the ``documents`` table.
RULES_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols
  FROM t),
g AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 4)) AS i,
         unnest(list_transform(generate_series(1, len(words) - 4), lambda k: words[k:k + 4])) AS window5
  FROM w WHERE len(words) > 5),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, window5) > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, generate_series(0, 4) AS s(k) GROUP BY doc_id),
l AS (
  SELECT doc_id, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         len(regexp_extract_all(line, '[^\p{L}\p{M}\p{N}\x20\x09-\x0D]')) AS marks,
         length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars,
         len(regexp_extract_all(line, '[|»›•·]')) AS seps
  FROM (SELECT doc_id, unnest(lines) AS line FROM w)),
lost AS (
  SELECT doc_id, sum(chars) AS lost_chars FROM l
  WHERE (n >= 5 AND marks * 100 > chars * 20)
     OR (n < 5 AND NOT regexp_matches(line, '[.!?…。！？:;]["''”’»)\]]*[\x20\x09-\x0D]*$'))
     OR (seps >= 3 AND seps * 4 >= n)
     OR (n <= 12 AND regexp_matches(line, '(?i)\b(all rights reserved|cookie policy|privacy policy|terms of (use|service)|enable javascript|sign (in|up)|log ?in|subscribe (now|to)|click here|share (this|on)|skip to (main )?content|lorem ipsum|alle rechte vorbehalten|datenschutzerkl[aäÄ]rung|nutzungsbedingungen|hier klicken|jetzt (anmelden|abonnieren)|zum inhalt springen|tous droits r[eéÉ]serv[eéÉ]s|mentions l[eéÉ]gales|politique de (confidentialit\S*|cookies)|conditions d[''’]utilisation|cliquez ici|abonnez-vous|aller au contenu|todos los derechos reservados|aviso legal|pol[iíÍ]tica de (privacidad|cookies)|condiciones de uso|ha(ga|z) clic|inicia(r)? sesi[oóÓ]n|suscr[iíÍ]bete|saltar al contenido)\b'))
  GROUP BY doc_id),
m AS (
  SELECT doc_id, len(words) AS n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost_chars, 0) AS lost_chars
  FROM w LEFT JOIN c USING (doc_id) LEFT JOIN lost USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(lost_chars AS BIGINT) AS lost_chars,
       n_words < 10 OR n_repeat_words * 100 > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR n_repeat_words * 100 > 20 * n_words) AND lost_chars * 100 <= word_chars * 30 AS kept
FROM m
"""
