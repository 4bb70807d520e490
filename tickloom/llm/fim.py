"""Fill-in-middle: documents cut at line ends, which summaries of content-defined chunks locate.

A rolling hash cuts a text into chunks that depend on the content alone, so that passages which documents share are cut
alike. What a chunk says about lines, code points and marks is worked out once and remembered; a remembered chunk is
compared byte by byte before it is believed. A document's counts and cuts follow from the summaries of its chunks.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import apart, importable, whole

#: Before the prefix, the suffix and the middle. A text that holds one of them stays plain.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7

#: Bytes of a chunk at least and at most; between them one position in 256 ends one.
LEAST, MOST = 64, 4096
#: Bytes that the rolling hash looks back on.
WINDOW = 32
#: Bytes hashed at once.
BLOCK = 1 << 20
#: Bytes of chunks that a Python worker remembers, in each of two generations.
REMEMBERED = 16 << 20

_CONTINUATION = bytes(range(0x80, 0xC0))
_FIELDS = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


class Chunk(NamedTuple):
    """What cutting a document needs to know of a chunk."""

    chars: int
    #: (bytes, code points) up to and with each line feed.
    ends: tuple[tuple[int, int], ...]
    marked: bool


class Cut(NamedTuple):
    """A place in a document."""

    byte: int
    char: int


def summary(content: bytes) -> Chunk:
    ends, at, chars = [], 0, 0
    while (feed := content.find(b"\n", at)) >= 0:
        chars += code_points(content[at : feed + 1])
        at = feed + 1
        ends.append((at, chars))
    return Chunk(chars + code_points(content[at:]), tuple(ends), any(m in content for m in MARKS))


def code_points(content: bytes) -> int:
    """Of UTF-8, which may be cut inside a code point: one counts where it begins."""
    return len(content) if content.isascii() else len(content.translate(None, _CONTINUATION))


@lru_cache(1)
def _gear() -> np.ndarray:
    """A 32-bit number for each byte, by a multiplicative mix."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: the sum of the numbers of the last 32, each doubled once for every byte after it.

    It is built by doubling the width five times, so that no loop goes over the bytes.
    """
    h = _gear()[data]
    for width in (1, 2, 4, 8, 16):
        h[width:] += h[:-width] << np.uint32(width)
    return h


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text end. They depend on the bytes since the last cut alone."""
    n, may = len(data), []
    if n > LEAST:
        view = np.frombuffer(data, np.uint8)
        for start in range(0, n, BLOCK):
            begin = max(0, start - WINDOW + 1)
            ends = np.flatnonzero(rolling(view[begin : start + BLOCK]) >> np.uint32(24) == 0) + begin + 1
            may += ends[ends > start].tolist()
    out, at, i = [], 0, 0
    while n - at > LEAST:
        i = bisect_left(may, at + LEAST, i)
        at = min(may[i] if i < len(may) else n, at + MOST, n)
        out.append(at)
    if at < n:
        out.append(n)
    return out


class Memory:
    """Summaries of chunks by content, in bounded space: the older of two generations goes when the newer is full."""

    def __init__(self, size: int = REMEMBERED):
        self.size, self.used, self.new, self.old = size, 0, {}, {}
        self.hits = 0

    def __call__(self, content: bytes) -> Chunk:
        key = xxhash.xxh3_64_intdigest(content)
        found = self.new.get(key) or self.old.get(key)
        if found is not None and found[0] == content:
            self.hits += 1
            return found[1]
        out = summary(content)
        if self.used > self.size:
            self.old, self.new, self.used = self.new, {}, 0
        self.new[key] = content, out
        self.used += len(content) + 200 + 150 * len(out.ends)
        return out


@lru_cache(1)
def _memory() -> Memory:
    return Memory()


class Document:
    """A text as the summaries of its chunks: lines, code points, whether a mark is in it, and its line ends."""

    def __init__(self, data: bytes, memory: Memory):
        self.feeds, self.bytes, self.chars, self.chunks = [0], [0], [0], []
        self.marked, before, at = False, b"", 0
        for end in chunk_ends(data):
            content = data[at:end]
            chunk = memory(content)
            self.chunks.append(chunk)
            self.feeds.append(self.feeds[-1] + len(chunk.ends))
            self.bytes.append(end)
            self.chars.append(self.chars[-1] + chunk.chars)
            # a mark may lie across the boundary of two chunks or more
            seam = before + content[:2]
            self.marked = self.marked or chunk.marked or (b"<" in seam and any(m in seam for m in MARKS))
            before, at = (before + content[-2:])[-2:], end
        self.units = self.feeds[-1] + (not data.endswith(b"\n") and len(data) > 0)

    def after(self, units: int) -> Cut:
        """The end of so many units."""
        if units > self.feeds[-1]:
            return Cut(self.bytes[-1], self.chars[-1])
        if units == 0:
            return Cut(0, 0)
        i = bisect_left(self.feeds, units) - 1
        byte, char = self.chunks[i].ends[units - self.feeds[i] - 1]
        return Cut(self.bytes[i] + byte, self.chars[i] + char)


def draws(seed: int, name: str) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 of a document's name."""
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def transformed(data: bytes, name: str, seed: int, share: int, spm: int, memory: Memory) -> tuple:
    """(units, form, code points of prefix and middle, output) of one text."""
    doc = Document(data, memory)
    h1, h2, h3, h4 = draws(seed, name)
    if not data or doc.marked or h3 % 100 >= share:
        return doc.units, "plain", None, None, data
    first, second = sorted((h1 % (doc.units + 1), h2 % (doc.units + 1)))
    first, second = doc.after(first), doc.after(second)
    prefix, middle, suffix = data[: first.byte], data[first.byte : second.byte], data[second.byte :]
    if h4 % 100 < spm:
        form, output = "spm", b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    else:
        form, output = "psm", b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    return doc.units, form, first.char, second.char - first.char, output


def _transform(id_col: str, text_col: str, seed: int, share: int, spm: int):
    @F.arrow_udf(_FIELDS)
    def transform(names: pa.Array, texts: pa.Array) -> pa.Array:
        memory = _memory()
        rows = [
            transformed(text.as_py(), name.as_py(), seed, share, spm, memory)
            for name, text in zip(names, texts.cast(pa.binary()), strict=True)
        ]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ((),) * 5
        arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                  pa.array(middle, pa.int64()), pa.array(output, pa.binary()).view(pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n", "form", "prefix_chars", "middle_chars", "output"])

    return transform(F.coalesce(F.col(id_col).cast("string"), F.lit("")), whole(text_col))


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, share: int = 100, spm: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents and five columns after their own: n, form, prefix_chars, middle_chars, output.

    A text is cut into lines, each with its line feed. ``share`` of a hundred documents are rearranged, ``spm`` of a
    hundred of those with the suffix first; the draws depend on the seed and the document's identifier (null: none).
    Null texts count as empty; empty texts, and those that hold a mark, stay plain and have no prefix or middle. Repeated
    rows are rearranged alike. Where a document has a column of one of these names, the new one gets underscores before
    it; all others come back as they are. No rows are moved; an empty table gives an empty result.
    """
    names = apart(docs.columns, "n", "form", "prefix_chars", "middle_chars", "output", "_fim")
    made = importable(docs).withColumn(names[-1], _transform(id_col, text_col, seed, share, spm))
    fields = ("n", "form", "prefix_chars", "middle_chars", "output")
    return made.select(*docs.columns, *[F.col(f"{names[-1]}.{f}").alias(to) for f, to in zip(fields, names, strict=False)])


def restored(output: Column | str, form: Column | str) -> Column:
    """The text from the output and its form. Each mark is there once: no text that is rearranged holds one, and none
    can arise where a mark meets a text, since all three begin with < and end with >, which occur in them once."""
    output, form = (F.col(x) if isinstance(x, str) else x for x in (output, form))
    p, s, m = (F.instr(output, mark.decode()) for mark in MARKS)
    width = F.lit(len(PREFIX))
    middle = F.substr(output, m + width)
    psm = F.concat(F.substr(output, width + 1, s - width - 1), middle, F.substr(output, s + width, m - s - width))
    spm = F.concat(F.substr(output, p + width, m - p - width), middle, F.substr(output, width + 1, p - width - 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id column, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = fill_in_middle(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), id_col="id")
    return made.select(
        F.col("id").alias(id_col),
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"),
    )
