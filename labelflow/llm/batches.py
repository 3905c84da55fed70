"""Whole texts in Arrow batches, for operators that run Python inside tasks."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CHUNK = 1 << 20
RUN = 4 << 20  # bytes of texts that are taken up at once
SPACE = re.compile(rb"[ \t-\r]")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def chunks(text: bytes, size: int = CHUNK) -> Iterator[bytes]:
    """Cut a text at white space into pieces of about ``size`` bytes, so that the word list of a
    very long text is never held as a whole. A word longer than ``size`` stays in one piece."""
    at = 0
    while len(text) - at > size:
        cut = SPACE.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def word_lists(text: bytes) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, a bounded list at a time."""
    for piece in chunks(text):
        if words := piece.split():
            yield words


def slices(batch: pa.RecordBatch, text: int, size: int = RUN) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes in column ``text``, one row at least,
    so that what is made from the rows goes out before the rest is begun."""
    lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def free_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def nullable(schema: StructType) -> StructType:
    for field in schema:
        field.nullable = True
    return schema


def map_text(df: DataFrame, text: str, new: dict[str, str], start: Callable[[], Callable[[pa.Array], list[pa.Array]]], size: int = RUN) -> DataFrame:
    """The columns of ``df`` but ``text``, and the ``new`` ones (name and type), made from the text;
    columns of these names are replaced. ``start`` is called once per task and returns the function
    from a run of texts (about ``size`` bytes) to the new columns."""
    kept = [c for c in df.columns if c != text and c.lower() not in {n.lower() for n in new}]
    names = [f"`{c}`" for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            for b in slices(batch, len(kept), size):
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *make(b.column(len(kept)))], [*kept, *new])

    schema = df.select(*names, *(F.lit(None).cast(kind).alias(n) for n, kind in new.items())).schema
    return df.select(*names, F.col(f"`{text}`").cast("string").alias(free_name("_text", kept))).mapInArrow(run, nullable(schema))


class Memo(dict):
    """Remembers ``make(key)`` for the keys used of late: a full generation of ``limit`` keys or ``room``
    characters (or bytes) of keys becomes the old one, from which keys come back when used, and the one
    before it is forgotten. Keys of over ``longest`` are made anew each time, so that neither many
    nor long words of a kind (base64, code in one line) fill the memory."""

    def __init__(self, make, limit: int = 500_000, room: int = 32 << 20, longest: int = 1024):
        super().__init__()
        self.make, self.limit, self.room, self.longest = make, limit, room, longest
        self.held = 0
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) > self.longest:
            return value
        if len(self) >= self.limit or self.held >= self.room:
            self.old = dict(self)
            self.clear()
            self.held = 0
        self[key] = value
        self.held += len(key)
        return value


def worker_state(key, make=lambda: None):
    """``make()``, kept by this Python worker for later tasks with the same key. Only the last key's
    value is kept, and it is forgotten before the next is made; a stage that keeps nothing may say so
    by a key alone. (The package travels by value, so a global of a module is new in every task.)"""
    home = sys.modules.setdefault("_labelflow_worker", ModuleType("_labelflow_worker"))
    if getattr(home, "key", None) != key:
        home.key = home.value = None
        pa.default_memory_pool().release_unused()
        home.value, home.key = make(), key
    return home.value
