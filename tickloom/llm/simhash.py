"""SimHash near-dedup: fingerprints compared as bit planes, and the components of their links."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import apart, importable, stage, whole
from tickloom.llm.graph import components

BITS = 64
#: Fingerprints of one bucket that are compared in one go; a larger bucket is cut into pairs of tiles.
TILE = 1024
#: Rows of whole buckets that a task compares together, about.
CHUNK = 16_384


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of 64 consecutive values in each word (the last word is padded with zeros)."""
    n = -(-len(values) // BITS) * BITS
    padded = np.zeros(n, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    turned = bits.reshape(n // BITS, BITS, BITS).transpose(2, 0, 1)
    return np.packbits(np.ascontiguousarray(turned), axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the values, counted for all 64 bits at once by carry-save adders.

    Three words of one weight become a sum of that weight and a carry of twice the weight, until one word of each
    weight is left: together they are 64 vertical counters.
    """
    if not len(hashes):
        return 0
    counters, words = [], hashes
    while len(words):
        carries = []
        while len(words) > 1:
            if len(words) == 2:
                a, b = words[:1], words[1:]
                carries.append(a & b)
                words = a ^ b
                break
            third = len(words) // 3
            a, b, c, rest = words[:third], words[third : 2 * third], words[2 * third : 3 * third], words[3 * third :]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate([half ^ c, rest])
        counters.append(int(words[0]))
        words = np.concatenate(carries) if carries else np.empty(0, np.uint64)
    # count > n // 2 for each bit, from the highest weight down
    least, above, equal = len(hashes) // 2, 0, (1 << BITS) - 1
    for weight in reversed(range(max(len(counters), least.bit_length()))):
        word = counters[weight] if weight < len(counters) else 0
        if least >> weight & 1:
            equal &= word
        else:
            above |= equal & word
            equal &= ~word
    return above


def fingerprint(text: str, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of a whole text over word shingles, repeats included; 0 without words."""
    words = text.encode().lower().split()  # bytes: only A-Z are lowered, only ASCII white space splits
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[: len(words) - shingle] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    return _majority(np.array(hashes, np.uint64))


def fingerprint_column(text_col: str, shingle: int):
    """The fingerprint of a text column as a signed long."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        values = [fingerprint(x.as_py() or "", shingle) for x in texts]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return prints(whole(text_col))


def close_pairs(values: np.ndarray, ends: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j < ends[i] whose values differ in `radius` bits at most.

    Each value is compared with words of 64 others at a time. The distances are vertical counters that start so high
    that one more than the radius overflows; a word is abandoned when all of its counters have.
    """
    n, planes = len(values), _planes(values)
    at = np.arange(n)
    first, last = (at + 1) // BITS, (ends - 1) // BITS
    count = np.where(ends > at + 1, last - first + 1, 0)
    query = np.repeat(at, count)
    block = np.arange(len(query)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    full, one = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)
    low = np.maximum(query + 1 - block * BITS, 0).astype(np.uint64)
    high = np.minimum(ends[query] - block * BITS, BITS).astype(np.uint64)
    live = (full << low) & (full >> (np.uint64(BITS) - high))
    width = (radius + 1).bit_length()
    bias = (1 << width) - 1 - radius
    counters = [np.full(len(query), full if bias >> k & 1 else 0, np.uint64) for k in range(width)]
    for b in range(BITS):
        sign = np.uint64(0) - ((values[query] >> np.uint64(b)) & one)
        carry = (planes[b][block] ^ sign) & live
        for k in range(width):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        live &= ~carry
        if b % 4 == 3:
            alive = live != 0
            query, block, live = query[alive], block[alive], live[alive]
            counters = [c[alive] for c in counters]
    if not len(query):
        return query, block
    bits = np.unpackbits(live.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    row, member = np.nonzero(bits)
    return query[row], block[row] * BITS + member


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position of each position's component under the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _links(radius: int):
    """For batches sorted by bucket: links that connect what the radius connects within a bucket, not all pairs."""

    def chunk(table: pa.Table) -> pa.RecordBatch:
        values = table["fp"].to_numpy().view(np.uint64)
        keys = np.stack([table[c].to_numpy() for c in ("combo", "key", "tile_a", "tile_b")])
        changed = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        edges = np.concatenate([[0], changed, [len(values)]])
        ends = np.repeat(edges[1:], np.diff(edges))
        label = spanning(len(values), *close_pairs(values, ends, radius))
        moved = np.flatnonzero(label != np.arange(len(values)))
        out = [values[moved].view(np.int64), values[label[moved]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["u", "v"])

    def last_key_start(table: pa.Table) -> int:
        keys = np.stack([table[c].to_numpy() for c in ("combo", "key", "tile_a", "tile_b")])
        return int(np.flatnonzero((keys != keys[:, -1:]).any(axis=0))[-1] + 1) if (keys != keys[:, -1:]).any() else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            if held.num_rows >= CHUNK and (cut := last_key_start(held)):
                yield chunk(held.slice(0, cut).combine_chunks())
                held = held.slice(cut).combine_chunks()
        if held is not None:
            yield chunk(held.combine_chunks())

    return run


def _masks(count: int, radius: int) -> list[int]:
    """Bit masks of which any two values within the radius agree on one at least.

    The 64 bits are cut into radius + m pieces, of which m must agree. m is the smallest for which m pieces have enough
    bits to tell `count` random values apart, so that a bucket does not grow with the corpus.
    """
    m = 1
    while m < 8 and BITS * m // (radius + m) < count.bit_length() + 2:
        m += 1
    pieces = radius + m
    edges = [BITS * i // pieces for i in range(pieces + 1)]
    masks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(pieces)]
    return [sum(masks[i] for i in some) for some in combinations(range(pieces), m)]


def fingerprint_groups(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(fp, root) for the distinct values of a column fp (long): root names the component at `radius` or fewer bits.

    Buckets hold the distinct fingerprints that agree on one of the masks. Buckets of one are dropped by a count;
    buckets above a tile are cut into pairs of tiles by a hash, each pair compared on its own, so that no task gets
    a bucket whole and no pair is missed.
    """
    distinct = stage(prints.select("fp").distinct(), "fingerprints")
    masks = _masks(distinct.count(), radius)
    signed = [x - (1 << BITS) if x >> (BITS - 1) else x for x in masks]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(x)) for x in signed]))).toDF(
        "fp", "combo", "key"
    )
    sizes = keyed.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    pair = F.when(
        F.col("tiles") > 1,
        F.transform(
            F.sequence(F.lit(0), F.col("tiles") - 1),
            lambda j: F.struct(F.least(F.col("tile"), j).alias("a"), F.greatest(F.col("tile"), j).alias("b")),
        ),
    ).otherwise(F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))))
    compared = (
        keyed.join(sizes, ["combo", "key"])
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .select("fp", "combo", "key", F.explode(pair).alias("pair"))
        .select("fp", "combo", "key", F.col("pair.a").alias("tile_a"), F.col("pair.b").alias("tile_b"))
        .repartition("combo", "key", "tile_a", "tile_b")
        .sortWithinPartitions("combo", "key", "tile_a", "tile_b", "fp")
    )
    links = compared.mapInArrow(_links(radius), "u long, v long")
    roots = components(links)
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def simhash_classes(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its id, fingerprint (16 hexadecimal digits) and component_id.

    The component is that of all links of `radius` or fewer bits; its id is the smallest identifier in it, null only
    where all identifiers of a component are. Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows come back as often as they are. Other columns are not read; an empty table gives an empty result.
    """
    docs = importable(docs)
    prints = stage(
        docs.select(F.col(id_col).alias("id"), fingerprint_column(text_col, shingle).alias("fp")), "simhash"
    )
    roots = fingerprint_groups(prints, radius)
    least = prints.groupBy("fp").agg(F.min("id").alias("least"))
    grouped = least.join(roots, "fp")
    named = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    # dealt anew, so that the join on root has its own exchange: a component of most fingerprints can be split
    named = named.repartition(F.xxhash64("root"))
    by_print = grouped.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns: one row of each component.

    The row with the smallest identifier stays, a null identifier last; among rows that repeat it, the first as read.
    """
    fp, row = apart(docs.columns, "fp", "row")
    docs = stage(
        importable(docs).withColumn(fp, fingerprint_column(text_col, shingle)).withColumn(row, F.monotonically_increasing_id()),
        "simhash-documents",
    )
    who = F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    prints = docs.select(F.col(fp).alias("fp"), who.alias("who"))
    best = prints.groupBy("fp").agg(F.min("who").alias("who"))
    stays = best.join(fingerprint_groups(prints, radius), "fp").groupBy("root").agg(F.min("who").alias("who"))
    stays = stage(stays.select(F.col("who.row").alias("stays")), "simhash-stays")
    # one of two documents or so stays: a table that grows with the documents is not broadcast
    return docs.join(stays.hint("merge"), docs[row] == stays["stays"], "left_semi").drop(fp, row)
