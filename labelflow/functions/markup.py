"""Markup to visible text.

Two ways. The JVM way is one ``regexp_replace`` plus literal replacements; it agrees with the
parser on well-formed markup that uses the entities listed here. The other way is the standard
library HTML parser in an Arrow-batched UDF, which also follows it on broken markup.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Named entities decoded on the JVM side.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&apos;", "'"),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]

# One alternation, so a single pass drops whole script and style elements, comments, the
# document type and tags. Possessive quantifiers keep it linear on long documents.
_MARKUP = (
    r"(?is)<(script|style)(?:\s[^<>]*+)?>[^<]*+(?:<(?!/\1)[^<]*+)*+</\1\s*+>"
    r"|<!--.*?-->"
    r"|<!doctype[^<>]*+>"
    r"|</?[a-z](?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
)
# A run of blanks, or one blank character that is no plain space: single spaces stay untouched.
_BLANKS = r"(?U)[\s\x1c-\x1f]{2,}+|[\s\x1c-\x1f&&[^ ]]"


def collapse_blanks(c: Column) -> Column:
    """Every run of Unicode white space becomes one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, _BLANKS, " "))


def _decode(c: Column) -> Column:
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def strip_markup_sql(c: Column) -> Column:
    """JVM way: drop markup, then decode entities twice."""
    return _decode(_decode(F.regexp_replace(c, _MARKUP, "")))


class _Visible(HTMLParser):
    """Collects character data outside script, style and template elements."""

    hidden = ("script", "style", "template")

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in self.hidden

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if tag in self.hidden and self.depth:
            self.depth -= 1

    def handle_data(self, data):
        if not self.depth:
            self.parts.append(data)


_WHITE = re.compile(r"\s+")


def visible_text(markup: str) -> str | None:
    """Visible text of one document; None when the parser refuses it."""
    parser = _Visible()
    try:
        parser.feed(markup)
        parser.close()
    except (AssertionError, ValueError):
        return None
    return _WHITE.sub(" ", html.unescape("".join(parser.parts))).strip()


@F.pandas_udf(StringType())
def parse_markup(texts: pd.Series) -> pd.Series:
    """NULL in, NULL out: rows without markup arrive as NULL and cost nothing."""
    return texts.map(lambda t: None if t is None else visible_text(t))


# Same function, marked so that Spark neither repeats it nor moves a filter on its result below it.
parse_markup_once = F.pandas_udf(parse_markup.func, StringType()).asNondeterministic()
