"""Benchmark decontamination: pigeonhole pieces, and Myers' bit-parallel distance."""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import apart, importable, whole

#: Edits allowed for each character of a test item.
ERROR_RATE = 0.06
#: Characters of test items that one pass over the documents looks for; a larger test set takes more passes.
PASS_CHARS = 4_000_000


def normalised(text: str | None) -> str:
    """Lower case, white space as one space: both sides are compared in this form."""
    return " ".join((text or "").lower().split())


def budget(chars: int, rate: float) -> int:
    return int(chars * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """errors + 1 pieces of near equal length that cover the item: one of them is whole in any text within the errors."""
    edges = [len(item) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def myers(masks: dict[str, int], chars: int, text: str) -> int:
    """The least edit distance between the pattern and any part of the text (bit-parallel, one column per step).

    masks has, for each character, the pattern's positions as bits.
    """
    full, top = (1 << chars) - 1, 1 << (chars - 1)
    up, down, score, best = full, 0, chars, chars
    for c in text:
        same = masks.get(c, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best = score
        plus, minus = plus << 1, minus << 1
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical & full
    return best


class Matcher:
    """Finds the items that lie, within their error budget, anywhere in a text."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float):
        where = defaultdict(list)
        self.items = []
        for item_id, text in items:
            if not text:
                continue
            errors, number = budget(len(text), rate), len(self.items)
            masks = defaultdict(int)
            for i, c in enumerate(text):
                masks[c] |= 1 << i
            self.items.append((item_id, len(text), errors, dict(masks)))
            for offset, piece in pieces(text, errors):
                where[piece].append((number, offset))
        self.found = ahocorasick.Automaton()
        for piece, places in where.items():
            self.found.add_word(piece, (len(piece), places))
        if where:
            self.found.make_automaton()

    def __call__(self, text: str) -> list[tuple[int, int]]:
        if not self.items:
            return []
        windows = defaultdict(list)
        for end, (length, places) in self.found.iter(text):
            for number, offset in places:
                _, chars, errors, _ = self.items[number]
                start = end + 1 - length - offset
                windows[number].append((start - errors, start + chars + errors))
        out = {}
        for number, spans in windows.items():
            item_id, chars, errors, masks = self.items[number]
            spans.sort()
            a, b = spans[0]
            least = errors + 1
            for c, d in [*spans[1:], (len(text) + chars * 2, 0)]:
                if c <= b:
                    b = max(b, d)
                    continue
                least = min(least, myers(masks, chars, text[max(a, 0) : b]))
                a, b = c, d
                if least == 0:
                    break
            if least <= errors:
                out[item_id] = min(least, out.get(item_id, least))
        return sorted(out.items())


@lru_cache(4)
def _matcher(items: tuple[tuple[int, str], ...], rate: float) -> Matcher:
    return Matcher(items, rate)


FOUND = "array<struct<item_id:bigint,distance:int>>"
_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))


def _found(text_col: str, items: tuple[tuple[int, str], ...], rate: float):
    @F.arrow_udf(FOUND)
    def find(texts: pa.Array) -> pa.Array:
        match = _matcher(items, rate)
        return pa.array(
            [[{"item_id": i, "distance": d} for i, d in match(normalised(x.as_py()))] for x in texts], _FOUND
        )

    # else Spark calls it once to filter and once to read
    return find.asNondeterministic()(whole(text_col))


def item_passes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> list[tuple]:
    """The test items in blocks of about PASS_CHARS characters: what one automaton holds, whatever the test set's size."""
    chars = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    passes = int(chars // PASS_CHARS) + 1
    block = F.pmod(F.xxhash64(item_col, text_col), F.lit(passes))
    named = benchmark.where(F.col(item_col).isNotNull()).select(item_col, text_col, block.alias("block")).distinct()
    return [
        tuple(sorted((r[0], normalised(r[1])) for r in named.where(F.col("block") == i).collect()))
        for i in range(passes)
    ]


def with_items(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str = "items",
    rate: float = ERROR_RATE,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The documents with the items found in them: (item_id, distance) by item_id, an empty list where there are none.

    An item of m characters, normalised, is found where some part of the whole normalised text is within int(m x rate)
    edits of it; distance is the least found among overlapping piece hits. Null and empty texts hold nothing; null or
    empty items, and items without an identifier, are nowhere. Items that share an identifier count as one, with the
    least distance. Repeated rows get the same answer. No rows are moved between tasks.
    """
    importable(docs)
    found = [_found(text_col, items, rate) for items in item_passes(benchmark, item_col, item_text_col)]
    return docs.withColumn(out, F.array_sort(F.concat(*found)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """One row per document and item found in it: the id column, item_id, distance."""
    rows = docs.select(id_col, F.col(how.pop("text_col", "text")).alias("text"))
    found = with_items(rows.toDF("id", "text"), benchmark, "items", **how)
    return found.select(F.col("id").alias(id_col), F.inline("items"))


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without a test item, with all their columns."""
    (items,) = apart(docs.columns, "items")
    return with_items(docs, benchmark, items, **how).where(F.size(items) == 0).drop(items)
