"""Two tokenizers over the same text: which tokens of one stand for which of the other.

Byte offsets where tokens of both end cut a text into groups. Most groups are one token of each, and then the two lists
of ends are equal along a diagonal: exponential probing compares slices of them at the current shift of the indexes and
jumps over such a stretch at once. Where they differ, the group is resolved token by token and the shift is updated.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import importable, stage, whole
from tickloom.llm.pieces import MODEL, pieces, tokenizer_path, with_arrays

#: The byte-level tokenizer that the pieces are aligned with.
TOKENIZER = "byte_bpe_50k.json"
#: How it splits a text before merging (a fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Stretches without white space, or of it alone, that are merged by a heap from this length on.
LONG = 512
#: Pairs of ids that are broadcast at most: some 40 MB. More are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000

_SPACES = re.compile(r"\s{%d}" % LONG)


@lru_cache(1)
def byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer file: ids of texts, and the bytes that each id stands for.

    Its merges are numbered as its entries are, so that they can be applied by rank, as the faster of the two libraries
    does. That one takes time quadratic in the length of a word; a text with a long one goes to the other.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec, alphabet = json.loads(Path(path).read_text()), byte_of_character()
        special = {x["id"] for x in spec["added_tokens"]}
        entries = {i: entry for entry, i in spec["model"]["vocab"].items() if i not in special}
        self.bytes = [bytes(alphabet[c] for c in entries.get(i, "")) for i in range(max(entries) + 1)]
        merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in spec["model"]["merges"]]
        if merged != [entries.get(i) for i in range(256, 256 + len(merged))]:
            raise ValueError("only tokenizers whose merges are numbered as their entries are known")
        ranks = {b: i for i, b in enumerate(self.bytes) if i in entries}
        self.by_rank = Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if _SPACES.search(text) or max(map(len, text.split()), default=0) >= LONG:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.by_rank.encode_ordinary(text)


@lru_cache(2)
def byte_level(name: str = TOKENIZER) -> ByteLevel:
    return ByteLevel(tokenizer_path(name))


def diagonal_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B there are up to the end of each group. Both lists ascend and end alike.

    From a common end on, slices of the two lists are compared, of one entry, two, four and so on; where they differ, the
    width is halved until the first difference is found. What was equal are groups of one token each.
    """
    size, n = 8, len(ends_a)
    a, b = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    at_a, at_b = ends_a.tolist(), ends_b.tolist()
    # what follows a start up to the next one lies on one diagonal: the index of the first cut, the shift, the cuts
    starts, shifts, lengths = [], [], []
    i = shift = 0
    while i < n:
        here = start = i * size
        across, width = shift * size, size
        while a[here : here + width] == b[here + across : here + across + width]:
            here += width
            if here >= len(a):
                break
            width *= 2
        while width > size:
            width >>= 1
            if here + width <= len(a) and a[here : here + width] == b[here + across : here + across + width]:
                here += width
        here = min(here, len(a))
        if here > start:
            starts.append(i + 1)
            shifts.append(shift)
            lengths.append((here - start) // size)
            i = here // size
            if i == n:
                break
        j = i + shift
        end_a, end_b = at_a[i], at_b[j]
        while end_a != end_b:
            if end_a < end_b:
                i += 1
                end_a = at_a[i]
            else:
                j += 1
                end_b = at_b[j]
        i, shift = i + 1, j - i
        starts.append(i)
        shifts.append(shift)
        lengths.append(1)
    lengths = np.array(lengths, np.int64)
    before = np.cumsum(lengths) - lengths
    cuts = np.arange(lengths.sum()) + np.repeat(np.array(starts, np.int64) - before, lengths)
    return cuts, cuts + np.repeat(np.array(shifts, np.int64), lengths)


class Groups(NamedTuple):
    """The ids of a text in both tokenizers, and how many of each there are up to the end of each group."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray

    def links(self) -> np.ndarray:
        """The pairs of tokens that end together, as B's id * 2^32 + A's: of every group, the last one of each side."""
        return self.b[self.cuts_b - 1] << 32 | self.a[self.cuts_a - 1]


class Aligner:
    """Both tokenizers. A reads a space and the text, B the text alone, since it puts a space before it by itself."""

    def __init__(self, tokenizer: str, model: str):
        self.a, self.b = byte_level(tokenizer), pieces(model)
        self.widths = [np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)]
        self.digits = digits(max(len(self.a.bytes), len(self.b.bytes)))

    def __call__(self, text: str) -> Groups:
        """No tokens where the text is empty or the bytes of either side are not those of a space and the text."""
        none = Groups(*[np.zeros(0, np.int64)] * 4)
        if not text:
            return none
        spaced = " " + text
        data, a, b = spaced.encode(), self.a.encode(spaced), self.b.ids(text.encode())
        sides = (self.a.bytes, a), (self.b.bytes, b.tolist())
        if any(b"".join(map(spelled.__getitem__, ids)) != data for spelled, ids in sides):
            return none
        a, b = np.array(a, np.int64), b.astype(np.int64)
        return Groups(a, b, *diagonal_groups(np.cumsum(self.widths[0][a]), np.cumsum(self.widths[1][b])))

    def written(self, g: Groups) -> bytes:
        """The groups as text: A's ids joined by commas, a bar, B's ids likewise; groups joined by semicolons."""
        n = len(g.a) + len(g.b)
        group = np.arange(len(g.cuts_a))
        sizes_a, sizes_b = np.diff(g.cuts_a, prepend=0), np.diff(g.cuts_b, prepend=0)
        ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        # a token comes after those of its side, and after the other side's of all groups before (B: its own too)
        ids[np.arange(len(g.a)) + np.repeat((g.cuts_b - sizes_b)[group], sizes_a)] = g.a
        ids[np.arange(len(g.b)) + np.repeat(g.cuts_a[group], sizes_b)] = g.b
        sign[g.cuts_a + g.cuts_b - sizes_b - 1] = ord("|")
        sign[g.cuts_a + g.cuts_b - 1] = ord(";")
        text, width = self.digits
        rows, widths = text[ids], width[ids]
        rows[np.arange(n), widths] = sign
        return rows[np.arange(rows.shape[1]) <= widths[:, None]].tobytes()[:-1]


def digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The numbers below n as rows of decimal digits with room for one sign more, and how many digits each has."""
    most = len(str(n))
    text = np.array([str(i).ljust(most + 1) for i in range(n)], f"S{most + 1}").view(np.uint8).reshape(n, most + 1)
    return text, np.array([len(str(i)) for i in range(n)], np.int64)


@lru_cache(2)
def aligner(tokenizer: str = TOKENIZER, model: str = MODEL) -> Aligner:
    return Aligner(tokenizer, model)


def _lists(arrays: list[np.ndarray], kind: str) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in arrays])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays]).astype(kind)))


def with_groups(docs: DataFrame, tokenizer: str = TOKENIZER, model: str = MODEL, text_col: str = "text") -> DataFrame:
    """The documents and four arrays after their own columns: a_ids, b_ids, a_cuts, b_cuts.

    Group i is A's tokens from a_cuts[i - 1] to a_cuts[i] and B's likewise. Null and empty texts, and those whose tokens
    do not spell them, have empty arrays. Names that a document already has get underscores before them; its own columns
    come back as they are. Repeated rows are aligned alike, no row moves, and an empty table gives an empty result.
    """

    def load():
        align = aligner(tokenizer, model)
        return lambda data: tuple(x.astype(np.int32) for x in align(data.decode()))

    return with_arrays(docs, text_col, ("a_ids", "b_ids", "a_cuts", "b_cuts"), load)


_COUNTED = "struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups_sha256: string, pairs: array<bigint>, times: array<int>>"


def _counted(text_col: str, tokenizer: str, model: str):
    @F.arrow_udf(_COUNTED)
    def count(texts: pa.Array) -> pa.Array:
        align = aligner(tokenizer, model)
        sizes, digests, pairs, times = [], [], [], []
        for x in texts:
            g = align(x.as_py())
            links = g.links()
            found, n = np.unique(links, return_counts=True)
            sizes.append((len(g.a), len(g.b), len(g.cuts_a), len(links)))
            digests.append(hashlib.sha256(align.written(g)).hexdigest() if len(g.a) else "")
            pairs.append(found)
            times.append(n)
        columns = [pa.array(np.array(x, np.int64)) for x in zip(*sizes, strict=True)] if sizes else [pa.array([], pa.int64())] * 4
        columns += [pa.array(digests, pa.string()), _lists(pairs, "int64"), _lists(times, "int32")]
        names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
        return pa.StructArray.from_arrays(columns, names)

    return count(whole(text_col))


def link_counts(counted: DataFrame) -> DataFrame:
    """(pair, links, best): how many links of the corpus hold a pair of ids, and whether no pair of its B id has more.

    A pair is B's id * 2^32 + A's. Each task adds up its own links first, so a pair that every document has sends one row
    a task.
    """
    pairs = counted.select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = pairs.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("links"))
    counts = stage(counts, "link-counts")
    b_id = F.shiftright("pair", 32).alias("b_id")
    most = counts.groupBy(b_id).agg(F.max("links").alias("most"))
    return counts.withColumn("b_id", b_id).join(most, "b_id").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def alignment_report(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    model: str = MODEL,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """One row per document: its id column, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Every text is aligned once; what it links is staged by document, counted over the corpus, and looked up again. The
    table of counted pairs is broadcast only if it has at most ``broadcast_pairs`` rows, else it is joined by a shuffle.
    Null and empty texts, and those whose tokens do not spell them, have zeros and an empty digest. Repeated rows count
    as often as they come. An empty table gives an empty result; other columns are not read.
    """
    rows = importable(docs.select(F.col(id_col).alias("id"), _counted(text_col, tokenizer, model).alias("x")))
    counted = stage(rows.select("id", "x.*").withColumn("row", F.monotonically_increasing_id()), "alignments")
    counts = stage(link_counts(counted), "pair-counts")
    small = counts.count() <= broadcast_pairs
    held = counted.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    held = held.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = (
        held.join(F.broadcast(counts) if small else counts.hint("merge"), "pair")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("long").alias("n_best"),
            F.sum(F.col("times") * F.col("links")).cast("long").alias("count_sum"),
        )
    )
    none = F.lit(0).cast("long")
    return counted.join(sums, "row", "left").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", none).alias("n_best"),
        F.coalesce("count_sum", none).alias("count_sum"),
        "groups_sha256",
    )
