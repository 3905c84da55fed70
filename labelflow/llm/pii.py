"""Personal data in whole texts: plain identifiers, and disguised ones by offset-preserving transducers.

A transducer rewrites a text and remembers which source characters each rewritten stretch came from.
They run one after the other: character references, look-alike characters, at/dot disguises, spelled
numbers with spelled dots, spelled digits. The identifier rules run on the plain text (base spans) and on the rewritten one; a span found there
that holds rewritten characters is mapped back to the source. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import domains
from .batches import map_text, nullable, slices

Span = tuple[str, int, int]
KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"

# --- identifiers ---------------------------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match ends with its run of digits, so the look-behind drops none
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in linear time:
    from each ``@`` back over the local part, which can't reach into the match before it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        if domain := DOMAIN.match(text, at + 1):
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                yield start, done
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def identifiers(text: str) -> list[Span]:
    """All spans by kind as listed, then start. Matches that fail their check are dropped, not retried."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return found
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGIT.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


# --- transducers ---------------------------------------------------------------------------------

# Letters that look like Latin ones (Cyrillic, Greek), and signs that stand for @ . - + or nothing.
LETTERS = dict(zip("асеорхуіјѕԁһԛԝɡαεικνορτυχАВЕКМНОРСТХУІЈЅΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aceopxyijsdhqwgaeiknoptuxABEKMHOPCTXYIJSABEZHIKMNOPTYX"))
SIGNS = {
    "\ufe6b": "@", "\u2024": ".", "\u3002": ".", "\uff61": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-",
    "\u2212": "-", "\ufe63": "-", "\ufe62": "+", "\u00a0": " ", "\u2007": " ", "\u202f": " ",
}
REFERENCES = {"commat": "@", "period": ".", "plus": "+", "lowbar": "_", "hyphen": "-", "nbsp": " "}
HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGIT_WORDS = {
    w: str(n) for words in (
        "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
    ) for n, w in enumerate(words.split())
} | {"oh": "0", "zwo": "2"}


def _look_alikes() -> dict[int, str]:
    """Character map: full-width ASCII, decimal digits of any script, what compatibility forms (mathematical, circled,
    squared, in brackets, ligatures) stand for if that is ASCII letters, one digit or a sign of addresses, and the tables
    above. Raised and lowered digits stay: they are mostly footnotes and powers."""
    table = {}
    for c in range(256, 0x1FBFA):
        kind, _, _ = unicodedata.decomposition(chr(c)).partition(" ")
        plain = unicodedata.normalize("NFKC", chr(c))
        if len(plain) == 3 and plain[0] + plain[2] == "()":
            plain = plain[1]
        if plain.isascii() and (plain.isalpha() or kind not in ("<super>", "<sub>") and re.fullmatch("[0-9@._%+-]", plain)):
            table[c] = plain
    # letters in black circles and squares have no such form
    table |= {first + k: chr(65 + k) for first in (0x1F150, 0x1F170) for k in range(26)}
    table |= {0xFEE0 + c: chr(c) for c in range(0x21, 0x7F)}
    table |= {c: str(unicodedata.decimal(chr(c))) for c in range(128, 0x1FBFA) if unicodedata.decimal(chr(c), None) is not None}
    return table | {ord(k): v for k, v in (LETTERS | SIGNS | dict.fromkeys(HIDDEN, "")).items()}


LOOK_ALIKE = _look_alikes()
RARE = re.compile("[\u00a0\u00ad\u0100-\U0010ffff]")  # every key of LOOK_ALIKE is one of these

OPEN, CLOSE = r"[\[({<]", r"[\])}>]"
# How "at" and "dot" of an address are said (English, German, French, Italian, Spanish and Portuguese).
FORMS = (("at", "dot"), ("at|ät|klammeraffe", "punkt"), ("arobase|arrobase", "point"), ("chiocciola", "punto"), ("arroba", "punto|ponto"))
AT_WORDS, DOT_WORDS = ("|".join(dict.fromkeys("|".join(words).split("|"))) for words in zip(*FORMS))
MARKED_AT = re.compile(rf"\s?{OPEN}\s*(?:{AT_WORDS}|@)\s*{CLOSE}\s?", re.I)
MARKED_DOT = re.compile(rf"\s?{OPEN}\s*(?:{DOT_WORDS}|\.)\s*{CLOSE}\s?", re.I)
NAME, LABEL, SEP = r"[A-Za-z0-9_%+-]+", r"[A-Za-z0-9-]+", r"(?:\s+dot\s+|\.)"
# a written-out address: local part, sign, domain; which of these are ones is up to address_end
WRITTEN = re.compile(rf"(?<![\w.%+-])({NAME}(?:{SEP}{NAME}){{0,126}})(\s+at\s+|@)({LABEL}(?:{SEP}{LABEL}){{1,252}})", re.I)
BETWEEN = re.compile(SEP, re.I)
# the same in the words of the other languages: at and every dot, or all dots but the last, said
SPOKEN = tuple(
    (re.compile(rf"(?<![\w.%+-])({NAME}(?:(?:\s+(?:{dot})\s+|\.){NAME}){{0,126}})(\s+(?:{at})\s+|@)({LABEL}(?:(?:\s+(?:{dot})\s+|\.){LABEL}){{1,252}})", re.I),
     re.compile(rf"\s+(?:{dot})\s+|\.", re.I)) for at, dot in FORMS[1:])
SPOKEN_HINT = re.compile(rf"\s(?:{'|'.join(at for at, _ in FORMS[2:])}|klammeraffe)\s|\spunkt\s", re.I)
# an at sign, and dots, with blanks around them
SPACED = re.compile(rf"(?<![\w.%+-])({NAME}(?:(?:\s\.\s|\.){NAME}){{0,126}})(\s@\s?|@\s)({LABEL}(?:(?:\s\.\s|\.){LABEL}){{1,252}})")
SPACED_DOT = re.compile(r"\s?\.\s?")
SPACED_HINT = re.compile(r"\s@|@\s")
# only texts with one of these are searched for written-out addresses
HINT = re.compile(r"\s(?:dot\s|at\s+[a-z0-9-]+\.[a-z0-9.-]*[a-z]{2})", re.I)
NUMBER_DOT = re.compile(r"(?<=[0-9])\s+dot\s+(?=[0-9])", re.I)
DOT_WORD = re.compile(r"(?<=\S)\s+dot\s+", re.I)
MARKED = re.compile(rf"{OPEN}\s*(?:{AT_WORDS}|{DOT_WORDS}|[@.])\s*{CLOSE}", re.I)
REFERENCE = re.compile(rf"&(?:#([0-9]{{1,7}})|#x([0-9a-f]{{1,6}})|({'|'.join(REFERENCES)}));", re.I)
_word = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_token = rf"(?:(?:(?:double|triple)[\s-])?{_word}|[0-9]+)"
SPELLED = re.compile(rf"(?<![^\W_])(?:plus[\s-]+)?{_token}(?:[\s,.-]{{1,2}}{_token}){{3,}}(?![^\W_])", re.I)
SPELLED_WORD = re.compile(rf"(plus)[\s-]+|(?:(double|triple)[\s-])?({_word})|([\s,.-]{{2}}|[\n\t,.])", re.I)
_part = rf"(?:{_word}|[0-9]{{1,3}}(?![0-9]))"
SPELLED_IP = re.compile(rf"(?<![\w.-]){_part}(?:[\s-]{_part}){{0,2}}(?:(?:\s+(?:{DOT_WORDS})\s+|\.){_part}(?:[\s-]{_part}){{0,2}}){{3}}(?!\w)", re.I)
SPELLED_IP_PART = re.compile(rf"(\s+(?:{DOT_WORDS})\s+)|({_word})|([\s-])", re.I)
SAID_DOT = re.compile(rf"\s(?:{DOT_WORDS})\s", re.I)

Edit = tuple[int, int, str]


def look_alikes(text: str) -> list[Edit]:
    if text.isascii():
        return []
    return [(m.start(), m.end(), new) for m in RARE.finditer(text) if (new := LOOK_ALIKE.get(ord(m[0]))) is not None]


def references(text: str) -> list[Edit]:
    """``&#64;``, ``&#x40;``, ``&commat;`` and the like; blanks and control characters stay as they are."""
    if "&" not in text:
        return []
    edits = []
    for m in REFERENCE.finditer(text):
        code = int(m[1]) if m[1] else int(m[2], 16) if m[2] else 0
        if m[3]:
            edits.append((m.start(), m.end(), REFERENCES[m[3].lower()]))
        elif 0x20 < code < 0x110000 and not 0x7F <= code < 0xA0 and not 0xD800 <= code < 0xE000:
            edits.append((m.start(), m.end(), chr(code)))
    return edits


def marked_signs(text: str) -> list[Edit]:
    """``(at)``, ``[dot]`` and the like."""
    if not MARKED.search(text):
        return []
    return [(m.start(), m.end(), sign) for rule, sign in ((MARKED_AT, "@"), (MARKED_DOT, ".")) for m in rule.finditer(text)]


def address_end(text: str, m: re.Match) -> int:
    """Where the address of a match of ``WRITTEN`` ends: after its last label that is known and fits, or 0.

    A dot that is written out shows an address if the label after it is no word of running text, or the one before it is
    none, or the local part has signs in it. If only the "at" is written out, the local part must be no word of running text
    ("tickets at example.com"), and one without signs doesn't stand before "home.it" or "main.py"."""
    local = [x for x in BETWEEN.split(m[1]) if x]
    signs = len(local) > 1 or bool(re.search("[0-9_%+]", m[1]) and re.search("[A-Za-z]", m[1]))
    words = (all if signs else any)(domains.ordinary(w) for x in local for w in x.split("-"))
    seps = list(BETWEEN.finditer(text, *m.span(3)))
    begins, ends = [m.start(3), *(s.end() for s in seps)], [*(s.start() for s in seps), m.end(3)]
    for k in range(len(seps), 0, -1):
        before, label = text[begins[k - 1]:ends[k - 1]], text[begins[k]:ends[k]]
        if not domains.known(label) or seps[k - 1][0] == "." and label.istitle() and before.islower():
            continue  # "example.com.So": the next sentence
        plain = label.lower() in domains.PLAIN
        if any(s[0] != "." for s in seps[:k]):
            fits = plain or signs or not domains.ordinary(before)
        elif m[2] == "@":
            fits = DOT_WORD.search(m[1]) is not None and not words
        else:
            fits = not words and (signs or k > 1 or label.lower() not in domains.FILES and (plain or not domains.ordinary(before)))
        if fits:
            return ends[k]
    return 0


def last_label(text: str, m: re.Match, between: re.Pattern, spaced: bool) -> int:
    """Where the address of a match of ``SPOKEN`` or ``SPACED`` ends: after its last label that is known and fits, or 0.

    The words of the other languages are rarely met in running text, so "at" and "punkt" want a label that is no word, and
    the rest any known one. Around a spaced at sign the local part must be no word, and the label neither a word nor an
    ending of files, in one case ("q @ k.mT")."""
    a, b = m.span(2)
    at, seps = text[a:b].strip().lower(), list(between.finditer(text, *m.span(3)))
    begins, ends = [m.start(3), *(s.end() for s in seps)], [*(s.start() for s in seps), m.end(3)]
    said = any(s[0].strip() != "." for s in between.finditer(text, *m.span(1)))
    if spaced and any(domains.ordinary(w) for x in between.split(m[1]) for w in x.split("-") if w):
        return 0
    for k in range(len(seps), 0, -1):
        before, label = text[begins[k - 1]:ends[k - 1]], text[begins[k]:ends[k]]
        plain = label.lower() in domains.PLAIN
        if not domains.known(label) or label.istitle() and before.islower():
            continue
        if spaced:
            fits = plain and label.lower() not in domains.FILES and (label.islower() or label.isupper())
        else:
            fits = (plain or at not in ("at", "@")) and (at != "@" or said) and (
                at != "at" or said or any(s[0].strip() != "." for s in seps[:k]))
        if fits:
            return ends[k]
    return 0


def spoken_signs(text: str) -> list[Edit]:
    """At and dots of addresses in the words of other languages, and those with blanks around them."""
    rules = [(rule, between, False) for rule, between in SPOKEN] if SPOKEN_HINT.search(text) else []
    if "@" in text and SPACED_HINT.search(text):
        rules.append((SPACED, SPACED_DOT, True))
    edits = []
    for rule, between, spaced in rules:
        at = 0
        while m := rule.search(text, at):
            end = last_label(text, m, between, spaced)
            at = end or m.end(2)
            if end:
                edits += [(*m.span(2), "@")] if m[2] != "@" else []
                edits += [(d.start(), d.end(), ".") for x, y in (m.span(1), (m.start(3), end)) for d in between.finditer(text, x, y) if d[0] != "."]
                edits += [(end, end, " ")] if end < m.end() and text[end] == "." else []
    return edits


def written_signs(text: str) -> list[Edit]:
    """`` at `` and `` dot `` of written-out addresses, `` dot `` between digits. A blank is put between an address and
    a dot right behind it, which would draw the next word in."""
    if not HINT.search(text):
        return []
    edits, at = [], 0
    while m := WRITTEN.search(text, at):
        end = address_end(text, m)
        at = end or m.end(2)  # the domain of what is no address may be the local part of one
        if end:
            a, b = m.span(2)
            edits += [(a, b, "@")] if m[2] != "@" else []
            edits += [(d.start(), d.end(), ".") for x, y in (m.span(1), (b, end)) for d in DOT_WORD.finditer(text, x, y)]
            edits += [(end, end, " ")] if end < m.end() and text[end] == "." else []
    return edits + [(m.start(), m.end(), ".") for m in NUMBER_DOT.finditer(text)]


def spelled(text: str) -> bool:
    words = text.lower().replace("-", " ").replace(",", " ").replace(".", " ").split()
    return not DIGIT_WORDS.keys().isdisjoint(words)


def spelled_ips(text: str) -> list[Edit]:
    """Four numbers of up to three spelled or single digits with dots, said or not, between them."""
    if not SAID_DOT.search(text) or not spelled(text):
        return []
    edits = []
    for m in SPELLED_IP.finditer(text):
        if SAID_DOT.search(m[0]):
            for w in SPELLED_IP_PART.finditer(text, m.start(), m.end()):
                edits.append((w.start(), w.end(), "." if w[1] else DIGIT_WORDS[w[2].lower()] if w[2] else ""))
    return edits


def spelled_digits(text: str) -> list[Edit]:
    if not spelled(text):
        return []
    edits = []
    for m in SPELLED.finditer(text):
        for w in SPELLED_WORD.finditer(text, m.start(), m.end()):
            new = "+" if w[1] else " " if w[4] else DIGIT_WORDS[w[3].lower()] * {"double": 2, "triple": 3}.get((w[2] or "").lower(), 1)
            edits.append((w.start(), w.end(), new))
    return edits


class Rewritten:
    """A text after edits, with the way back to the text before them."""

    def __init__(self, text: str, edits: list[Edit]):
        parts, at, size = [], 0, 0
        self.starts, self.origin = [0], [(0, 0, 0)]  # where a stretch begins; its source begin, end, and 1 if it is an edit
        for a, b, new in sorted(edits):
            if a < at:
                continue  # an earlier edit covers it
            self._stretch(size, at, a, 0)
            size += a - at
            self._stretch(size, a, b, 1)
            size += len(new)
            parts += [text[at:a], new]
            at = b
        self._stretch(size, at, len(text), 0)
        self.text = "".join([*parts, text[at:]])

    def _stretch(self, begin: int, a: int, b: int, edited: int) -> None:
        self.starts.append(begin)
        self.origin.append((a, b, edited))

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a span of the rewritten text, and whether it holds an edit."""
        first, last = (bisect_right(self.starts, p) - 1 for p in (start, end - 1))
        a, _, edited = self.origin[first]
        a += 0 if edited else start - self.starts[first]
        z, b, last_edited = self.origin[last]
        b = b if last_edited else z + end - self.starts[last]
        return a, b, any(self.origin[k][2] for k in range(first, last + 1))


TRANSDUCERS = (references, look_alikes, marked_signs, written_signs, spoken_signs, spelled_ips, spelled_digits)


def disguised(text: str) -> list[Span]:
    """Source spans of identifiers that only the rewritten text shows."""
    steps, now = [], text
    for rule in TRANSDUCERS:
        if edits := rule(now):
            steps.append(Rewritten(now, edits))
            now = steps[-1].text
    found = []
    for kind, a, b in identifiers(now) if steps else ():
        touched = False
        for step in reversed(steps):
            a, b, edited = step.back(a, b)
            touched |= edited
        if touched:
            found.append((kind, a, b))
    return found


def all_spans(text: str) -> list[tuple[str, int, int, bool]]:
    """Base spans, and disguised ones that no base span of their kind contains; by kind as listed, then start."""
    base = identifiers(text)
    of_kind = {kind: [(a, b) for k, a, b in base if k == kind] for kind in KINDS}

    def covered(kind: str, a: int, b: int) -> bool:
        """Base spans of a kind don't overlap: only the last one that begins by ``a`` can hold the span."""
        k = bisect_right(of_kind[kind], a, key=lambda s: s[0])
        return k > 0 and b <= of_kind[kind][k - 1][1]

    more = [s for s in disguised(text) if not covered(*s)]
    return sorted([(*s, True) for s in base] + [(*s, False) for s in more], key=lambda s: (KINDS.index(s[0]), s[1:]))


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are one."""
    out, at, done = [], 0, 0
    for kind, a, b, _ in sorted(all_spans(text), key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = done = max(done, b)
    return text if not out else "".join([*out, text[at:]])


# --- operators -----------------------------------------------------------------------------------


def find_personal(df: DataFrame, text: str = "text", column: str = "spans") -> DataFrame:
    """The columns of ``df`` but ``text``, and ``column``: kind, start, end (code points) and whether
    it is a base span. Null counts as the empty text, which has no spans. Rows are treated one by
    one, so repeated rows get equal results and an empty table an empty one."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def make(texts: pa.Array) -> list[pa.Array]:
        names = ("kind", "start", "end", "base")
        return [pa.array([[dict(zip(names, s)) for s in all_spans(t or "")] for t in texts.to_pylist()], kind)]

    return map_text(df, text, {column: SPANS}, lambda: make)


def mask_personal(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with its spans masked in ``text``; ``n_chars``, if there is such a column, counts the new
    text where it has changed. Null stays null."""
    at = df.columns.index(text)
    size = df.columns.index("n_chars") if "n_chars" in df.columns else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, at):
                before = b.column(at).to_pylist()
                after = [t if t is None else masked(t) for t in before]
                columns = list(b.columns)
                columns[at] = pa.array(after, b.schema.field(at).type)
                if size >= 0:
                    counts = [n if x is y else len(y) for n, x, y in zip(b.column(size).to_pylist(), before, after)]
                    columns[size] = pa.array(counts, b.schema.field(size).type)
                yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return df.mapInArrow(run, nullable(df.schema))


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
