"""Scalar functions over text columns. All but the parser mode of ``clean_text`` stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .markup import collapse_blanks, parse_markup, parse_markup_once, strip_markup_sql

__all__ = [
    "clean_text", "clean_text_flagged", "blank_to_empty", "parse_time", "combine_text", "summary_text",
    "extract_tags", "metadata_kind", "text_length", "label_plus_desc", "escape_prompt", "preview", "split_items", "is_none_reply",
    "percentage", "name_terms", "description_terms", "ancestor_paths", "words", "empty_strings", "or_empty",
    "sample_order", "collapse_blanks",
]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- cleaning ---------------------------------------------------------------------------------

def _marked(c: Column) -> Column:
    return F.contains(c, F.lit("<")) | F.contains(c, F.lit("&"))


def clean_text(c: str | Column, mode: str = "parser", once: bool = False) -> Column:
    """Visible text of ``c`` with blanks collapsed; NULL gives ``''``.

    ``parser`` sends rows that hold ``<`` or ``&`` to the HTML parser and cleans the others in
    the JVM; ``sql`` stays in the JVM for all rows (see ``markup`` for when both agree). Set
    ``once`` where a later filter reads the result, so that the parser does not run again for it.
    """
    c = _c(c)
    if mode == "parser":
        parse = parse_markup_once if once else parse_markup
        text = F.when(_marked(c), parse(F.when(_marked(c), c))).otherwise(collapse_blanks(c))
    elif mode == "sql":
        text = collapse_blanks(F.when(_marked(c), strip_markup_sql(c)).otherwise(c))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(text, F.lit(""))


def clean_text_flagged(c: str | Column) -> Column:
    """Struct ``(text, failed)``: text the parser refuses becomes ``''`` and is flagged."""
    c = _c(c)
    text = F.when(_marked(c), parse_markup(F.when(_marked(c), c))).otherwise(collapse_blanks(c))
    return F.struct(
        F.coalesce(text, F.lit("")).alias("text"), (c.isNotNull() & text.isNull()).alias("failed")
    )


def blank_to_empty(c: str | Column) -> Column:
    return F.coalesce(_c(c), F.lit(""))


def parse_time(c: str | Column) -> Column:
    """Timestamp, NULL where the text is no valid date."""
    return F.try_to_timestamp(_c(c))


def combine_text(title: str | Column, content: str | Column, trim: bool = True) -> Column:
    both = F.concat(blank_to_empty(title), F.lit(" "), blank_to_empty(content))
    return F.trim(both) if trim else both


def summary_text(title: str | Column, summary: str | Column) -> Column:
    return F.concat(blank_to_empty(title), F.lit(" | Summary: "), blank_to_empty(summary))


def extract_tags(metadata: str | Column, key: str = "raindrop_tags", kind: str = "json") -> Column:
    """Tag list under ``key``; anything that is no list gives ``[]``.

    ``kind`` tells how the metadata is stored: ``json`` text, ``variant``, or ``nested`` (a struct, or a
    map of lists or texts). A dot in ``key`` is part of the name.
    """
    m = _c(metadata)
    v = m if kind == "variant" else F.try_parse_json(m if kind == "json" else F.to_json(m))
    quote = '"' if "'" in key else "'"
    return F.coalesce(F.try_variant_get(v, f"$[{quote}{key}{quote}]", "array<string>"), empty_strings())


def metadata_kind(stored: T.DataType) -> str | None:
    """``kind`` for :func:`extract_tags` by column type; None for types that can't hold tags."""
    if isinstance(stored, T.VariantType):
        return "variant"
    if isinstance(stored, (T.StructType, T.MapType, T.ArrayType)):
        return "nested"
    return "json" if isinstance(stored, T.StringType) else None


def text_length(c: str | Column) -> Column:
    return F.coalesce(F.char_length(_c(c)), F.lit(0))


def empty_strings() -> Column:
    return F.array().cast("array<string>")


def or_empty(c: str | Column) -> Column:
    """NULL list becomes ``[]``."""
    return F.coalesce(_c(c), empty_strings())


def label_plus_desc(label: str | Column, description: str | Column) -> Column:
    return F.concat(_c(label), F.lit(": "), F.coalesce(_c(description), F.lit("No description")))


def escape_prompt(c: str | Column) -> Column:
    """Text made safe for a quoted one-line slot of a request."""
    out = blank_to_empty(c)
    for old, new in (("\\", "\\\\"), ('"', '\\"'), ("\n", " "), ("\r", "")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def preview(c: str | Column, n: int = 100) -> Column:
    c = _c(c)
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def split_items(c: str | Column, separator: str = ",", keep_empty: bool = False) -> Column:
    """Trimmed items of delimited text; ``separator`` is taken literally."""
    items = F.transform(F.split(_c(c), f"\\Q{separator}\\E"), _strip)
    return items if keep_empty else F.filter(items, lambda x: x != "")


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def is_none_reply(c: str | Column, trim: bool = True) -> Column:
    c = _c(c)
    return F.upper(_strip(c) if trim else c) == "NONE"


def percentage(part: str | Column, total: str | Column, digits: int = 2) -> Column:
    return F.round(_c(part) * 100.0 / F.nullif(_c(total), F.lit(0)), digits)


def words(c: str | Column) -> Column:
    """Lower-case runs of letters and digits."""
    # cutting at the gaps is several times faster than extracting the runs
    return F.array_remove(F.split(F.lower(_c(c)), r"[^\p{L}\p{N}]++"), "")


def sample_order(key: str | Column, seed: int) -> Column:
    """Seeded pseudo-random sort key of a row; the same for any partitioning."""
    return F.md5(F.concat_ws(":", _c(key).cast("string"), F.lit(str(seed))).cast("binary"))


# -- label terms and paths --------------------------------------------------------------------

# Fixed value: how a label name is cut at capitals.
CAPITAL_PART = r"[A-Z](?:[a-z]+|[A-Z]*(?=[A-Z]|$))"


def name_terms(label: str | Column) -> Column:
    """Lower-case parts of a label name: cut at ``_`` and blanks, then at capitals."""
    pieces = F.filter(F.split(F.replace(_c(label), F.lit("_"), F.lit(" ")), r"(?U)\s+"), lambda p: p != "")

    def cut(piece: Column) -> Column:
        parts = F.regexp_extract_all(piece, F.lit(CAPITAL_PART), F.lit(0))
        return F.transform(F.when(F.size(parts) > 0, parts).otherwise(F.array(piece)), F.lower)

    return F.flatten(F.transform(pieces, cut))


def description_terms(description: str | Column, strip_punct: bool = False) -> Column:
    """Lower-case words of more than three characters; punctuation stays on unless asked."""
    parts = F.split(F.lower(blank_to_empty(description)), r"(?U)\s+")
    if strip_punct:
        parts = F.transform(parts, lambda p: F.regexp_replace(p, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.filter(parts, lambda p: F.char_length(p) > 3)


def ancestor_paths(path: str | Column) -> Column:
    """All proper prefixes of a slash path, outermost first."""
    parts = F.split(_c(path), "/")
    depth = F.size(parts)
    # sequence(1, 0) would count down, so a root path is answered apart
    return F.when(
        depth > 1,
        F.transform(F.sequence(F.lit(1), F.greatest(depth - 1, F.lit(1))), lambda i: F.array_join(F.slice(parts, 1, i), "/")),
    ).otherwise(empty_strings())
