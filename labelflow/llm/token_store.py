"""Token ids in binary files: one array of ids per file, document boundaries as an Elias-Fano sequence.

An Elias-Fano sequence stores ``n`` rising numbers up to ``u`` in about ``n * (2 + log2(u / n))`` bits:
the low bits of each number packed, the high bits in unary. The k-th number is a select on the
unary bits, helped by the place of every 256th one; no table of 64-bit offsets is kept.

File: ids as little-endian unsigned integers of 2 or 4 bytes (by the size of the vocabulary), then
two sequences (document ids less the smallest, ends of documents in ids), then a trailer of fixed size.
"""

from __future__ import annotations

import os
import struct
import uuid
from array import array
from collections.abc import Iterator
from string import punctuation
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import fresh_path, written
from .batches import Memo, slices, worker_state

SAMPLE = 256
RUN = 1 << 14  # documents whose bounds are held at a time
WORDS, PARTS = 500_000, 350_000  # words and lower-case parts of words that a worker remembers, twice at most
TRAILER = "<8sBQQqQQQ"  # magic, id width, documents, ids, smallest doc id, null ids, lengths of the two sequences
MAGIC = b"EFIDS001"
HEAD = "<QBQQ"  # of a sequence: numbers, low bits, bytes of the low part, bytes of the high part
MANIFEST = "part bigint, path string, n_docs bigint, n_ids bigint"


class EliasFano:
    """A sequence of rising whole numbers from 0 on."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        low = b""
        if bits:
            place = np.arange(bits, dtype=np.uint64)
            step = (1 << 13) * 8  # a multiple of 8 numbers fills whole bytes
            low = b"".join(
                np.packbits(((values[a:a + step, None] >> place) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes()
                for a in range(0, n, step))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros((int(ones[-1]) // 8 + 1 if n else 0) * 8, np.uint8)
        unary[ones] = 1
        return cls(n, bits, low, np.packbits(unary, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def to_bytes(self) -> bytes:
        return b"".join([struct.pack(HEAD, self.n, self.low_bits, len(self.low), len(self.high)), self.low, self.high, self.samples.tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, bits, low, high = struct.unpack_from(HEAD, data)
        at = struct.calcsize(HEAD)
        return cls(n, bits, data[at:at + low], data[at + low:at + low + high], np.frombuffer(data, "<u4", offset=at + low + high))

    def _low(self, k: int) -> int:
        first, last = k * self.low_bits, (k + 1) * self.low_bits
        return int.from_bytes(self.low[first // 8:(last + 7) // 8], "little") >> first % 8 & (1 << self.low_bits) - 1

    def _place(self, k: int) -> int:
        """Where the k-th set bit is: from the sampled one before it, a word at a time."""
        if not 0 <= k < self.n:
            raise IndexError(k)
        start = int(self.samples[k // SAMPLE])
        left, at = k % SAMPLE, start // 64 * 8
        word = int.from_bytes(self.high[at:at + 8], "little") >> start % 64 << start % 64
        while left >= word.bit_count():
            left -= word.bit_count()
            at += 8
            word = int.from_bytes(self.high[at:at + 8], "little")
        for _ in range(left):
            word &= word - 1
        return at * 8 + (word & -word).bit_length() - 1

    def select(self, k: int) -> int:
        """The k-th number."""
        return self._place(k) - k << self.low_bits | self._low(k)

    def run(self, first: int, last: int) -> np.ndarray:
        """The numbers ``first`` to ``last - 1``: a select at either end, and the unary bits between them."""
        if first >= last:
            return np.zeros(0, np.int64)
        begin, end = self._place(first), self._place(last - 1) + 1
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8, (end + 7) // 8 - begin // 8, begin // 8), bitorder="little")
        ones = np.flatnonzero(bits[begin % 8:end - begin // 8 * 8])
        out = ones + (begin - np.arange(first, last)) << self.low_bits
        if self.low_bits:
            a, b = first * self.low_bits, last * self.low_bits
            bits = np.unpackbits(np.frombuffer(self.low, np.uint8, (b + 7) // 8 - a // 8, a // 8), bitorder="little")
            bits = bits[a % 8:a % 8 + b - a].reshape(-1, self.low_bits)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI; the shared folder may be on any that pyarrow knows."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), path[5:].replace("//", "", 1) if path.startswith("file://") else path[5:]
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class IdFile:
    """One file, for reading: its documents in order, by number."""

    def __init__(self, path: str):
        system, place = filesystem(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        end = size - struct.calcsize(TRAILER)
        magic, self.width, self.n_docs, self.n_ids, self.smallest, self.nulls, a, b = struct.unpack(TRAILER, self._at(end, size - end))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a file of ids")
        self.doc_ids = EliasFano.from_bytes(self._at(end - a - b, a))
        self.ends = EliasFano.from_bytes(self._at(end - b, b))

    def _at(self, offset: int, size: int) -> bytes:
        return self.file.read_at(size, offset)

    def doc_id(self, k: int) -> int | None:
        return None if k < self.nulls else self.doc_ids.select(k - self.nulls) + self.smallest

    def bounds(self, k: int) -> tuple[int, int]:
        return self.ends.select(k - 1) if k else 0, self.ends.select(k)

    def documents(self, first: int, last: int) -> tuple[pa.Array, np.ndarray]:
        """Ids of the documents ``first`` to ``last - 1``, and their bounds, one more."""
        known = self.doc_ids.run(max(first - self.nulls, 0), max(last - self.nulls, 0)) + self.smallest
        docs = pa.concat_arrays([pa.nulls(last - first - len(known), pa.int64()), pa.array(known, pa.int64())])
        return docs, np.concatenate([[self.ends.select(first - 1) if first else 0], self.ends.run(first, last)])

    def ids(self, begin: int, end: int) -> np.ndarray:
        return np.frombuffer(self._at(begin * self.width, (end - begin) * self.width), f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


def finish(out: BinaryIO, width: int, nulls: int, doc_ids: array, ends: array) -> None:
    """Write what follows the ids. ``doc_ids`` rise; the ``nulls`` documents without an id come before them."""
    smallest = doc_ids[0] if doc_ids else 0
    # the difference of two ids may be beyond a signed 64-bit number, not beyond an unsigned one
    known = np.array(doc_ids, np.int64).view(np.uint64) - np.array(smallest, np.int64).view(np.uint64)
    sequences = [EliasFano.of(known).to_bytes(), EliasFano.of(np.array(ends, np.uint64)).to_bytes()]
    out.write(b"".join([*sequences, struct.pack(TRAILER, MAGIC, width, len(ends), ends[-1] if ends else 0, smallest, nulls, *map(len, sequences))]))


def byte_alphabet() -> dict[int, str]:
    """Character that stands for each byte in byte-level vocabularies: itself if it can be printed,
    else the next one from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + odd.index(b)) for b in range(256)}


class Encoder:
    """Ids of whole texts by the tokenizers library.

    If the tokenizer drops white space, words are encoded on their own and remembered; if it also
    drops case and cuts signs off words, a word of letters is looked up in lower case without those at
    its end, and an unknown one goes to the library's model itself, as nothing is left to normalise or
    cut. Whether all this holds is tried out with every letter below U+0100 and every ASCII sign, not
    assumed; words with other letters or with signs inside go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.alphabet = byte_alphabet()
        spaced, a, b, c = self._many([" a  b\nc ", "a", "b", "c"])
        self.by_word = spaced == a + b + c
        self.by_part = self.by_word and all(
            self._many([x]) == [self._one(x.lower())] for c in map(chr, range(256)) if c.isalpha() for x in ("a" + c + "b", c)) and all(
            b"".join(self._many(["ab", run])) == self._many(["ab" + run])[0] for run in [*punctuation, punctuation, punctuation[::-1]])
        self.part = Memo(self._part, PARTS)
        self.word = Memo(self._word, WORDS)

    def _many(self, texts: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _one(self, word: str) -> bytes:
        """Ids of a lower-case word of letters, by the model alone."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return array(self.code, [t.id for t in self.model.tokenize(word)]).tobytes()

    def _part(self, part: str) -> bytes:
        return self._one(part) if part.isalpha() else self._many([part])[0]

    def _word(self, text: str) -> bytes:
        letters = text.rstrip(punctuation)
        if not self.by_part or not letters.isalpha() or max(letters) >= "\u0100":
            return self._many([text])[0]
        ids = self.part[letters.lower()]
        return ids if len(letters) == len(text) else ids + self.part[text[len(letters):]]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has. Every distinct word of
        the texts is looked up once, and the ids are gathered for all its places."""
        kind = f"<u{self.width}"
        if not self.by_word:
            whole = self._many([t or "" for t in texts.to_pylist()])
            return np.frombuffer(b"".join(whole), kind), np.array([len(w) // self.width for w in whole], np.int64)
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        words = lists.flatten().dictionary_encode()
        known = [self.word[w] if w else b"" for w in words.dictionary.to_pylist()]
        table = np.frombuffer(b"".join(known), kind)
        size = np.array([len(k) // self.width for k in known], np.int64)
        code = words.indices.to_numpy()
        count = size[code]
        ends = np.cumsum(count)
        first = np.repeat(((np.cumsum(size) - size)[code] - (ends - count)).astype(np.int32), count)
        bounds = np.concatenate([[0], ends])[lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()]
        return table[first + np.arange(len(first), dtype=np.int32)], np.diff(bounds)


def write_ids(df: DataFrame, tokenizer: str, folder: str, end_id: int | None = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode the texts and write them under ``folder`` in ascending ``doc_id`` order (null first, then
    by hash of the text). Returns the manifest, written to the shared folder: part, path, documents
    and ids of each file, in order of part.

    Rows are dealt by ranges of the id, hash and row number, so a repeated id or row is split as well.
    A task writes a file of a new name, and only the files that the manifest names count: what lost or
    repeated tasks leave behind is never read. Null and empty texts are documents of the end id alone.
    Ids must be whole numbers. An empty table gives an empty manifest.
    """
    rows = df.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    order = [F.col("doc").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    dealt = rows.withColumn("_hash", order[1]).withColumn("_row", order[2])
    order = [F.col("doc").asc_nulls_first(), "_hash", "_row"]
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).select("doc", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        coder, out, docs, ends, n = None, None, array("q"), array("q"), 0
        for batch in batches:
            for b in slices(batch, 1, 4 << 20):
                if out is None:
                    coder = worker_state(("ids", tokenizer), lambda: Encoder(tokenizer))
                    system, place = filesystem(folder)
                    system.create_dir(place, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.ids"
                    out = system.open_output_stream(f"{place}/{name}")
                docs.frombytes(b.column(0).drop_null().to_numpy().astype(np.int64).tobytes())
                ids, count = coder.encode(b.column(1))
                if end_id is not None:
                    ids, count = np.insert(ids, np.cumsum(count), end_id), count + 1
                ends.frombytes((n + np.cumsum(count)).astype(np.int64).tobytes())
                n += len(ids)
                out.write(ids.tobytes())
        if out is not None:
            finish(out, coder.width, len(ends) - len(docs), docs, ends)
            out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [f"{folder}/{name}"], "n_docs": [len(ends)], "n_ids": [n]})

    return written(dealt.mapInArrow(run, MANIFEST), "manifest")


def read_ids(manifest: DataFrame) -> DataFrame:
    """The documents of the files: ``doc_id``, ``start`` (ids in all documents before it), ``n_tokens``
    and ``ids`` (binary: little-endian unsigned 32-bit). The manifest has a row per file, whose
    offsets are summed in Spark; a task reads a file in runs of documents, each found by select."""
    from pyspark.sql.window import Window

    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                file = IdFile(path)
                for begin in range(0, file.n_docs, RUN):
                    docs, bounds = file.documents(begin, min(begin + RUN, file.n_docs))
                    first, n = 0, len(docs)
                    while first < n:
                        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + (1 << 21), "right")) - 1)
                        ids = file.ids(int(bounds[first]), int(bounds[last])).astype("<u4")
                        cuts = (bounds[first:last + 1] - bounds[first]) * 4
                        binary = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids)])
                        yield pa.RecordBatch.from_arrays([
                            docs[first:last], pa.array(bounds[first:last] + base), pa.array(np.diff(bounds[first:last + 1])), binary],
                            ["doc_id", "start", "n_tokens", "ids"])
                        first = last
                file.close()

    parts = max(1, min(manifest.count(), 100_000))
    return files.repartition(parts).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def id_folder(spark: SparkSession) -> str:
    """A new folder for files of ids under the shared folder."""
    return fresh_path(spark, "ids")
