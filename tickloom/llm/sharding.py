"""Sharding: longest-processing-time scheduling of groups that stay together."""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom.llm.common import apart, stage, whole

#: A group is scheduled by itself from this fraction of a shard on; the groups below share bundles.
PER_SHARD = 256
#: Bundles for each shard. Both bound what the scheduler gets: shards x (256 + 512) rows.
BUNDLES_PER_SHARD = 512
#: Rows numbered by one window, about.
ROWS_PER_NUMBERING = 20_000


def longest_first(units: Iterable[tuple[str, int]], shards: int) -> dict[str, int]:
    """Unit -> shard: the largest unit first, each to the least-loaded shard (ties: smallest unit name, smallest shard)."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for unit, size in sorted(units, key=lambda x: (-x[1], x[0])):
        load, s = heapq.heappop(heap)
        out[unit] = s
        heapq.heappush(heap, (load + size, s))
    return out


def number_within(df: DataFrame, by: str, order: list[str], name: str, rows: int) -> DataFrame:
    """Gapless numbers from 0 within each value of `by`, without one window per value.

    Rows are dealt to cells by a hash of the order columns, numbered within the cell, and offset by the sizes of the
    cells before it. Rows equal in all order columns are numbered in any order.
    """
    cell, at = apart(df.columns, "cell", "cell_start")
    cells = max(64, -(-rows // ROWS_PER_NUMBERING))
    df = df.withColumn(cell, F.pmod(F.xxhash64(*order), F.lit(cells)).cast("int"))
    sizes = df.groupBy(by, cell).count()
    before = Window.partitionBy(by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(by, cell, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(at))
    inside = Window.partitionBy(by, cell).orderBy(*order)
    return (
        df.withColumn(name, F.row_number().over(inside) - 1)
        .join(starts, [by, cell])
        .withColumn(name, (F.col(name) + F.col(at)).cast("long"))
        .drop(cell, at)
    )


def shard_by_bytes(docs: DataFrame, shards: int = 24, text_col: str = "text", overhead: int = 8) -> DataFrame:
    """The documents with size, group, shard: equal texts on one shard, sizes of the shards near equal.

    Size is the UTF-8 bytes of the text plus `overhead`. A null text counts as empty. Groups of at least 1/256 of a
    mean shard are scheduled one by one; smaller groups are dealt to bundles by their hash, and a bundle is scheduled
    like a group. So a shard exceeds the mean by about a bundle unless one group is larger than that.
    New columns are named `size`, `shard_group`, `shard`, with underscores before them where the input has such a name.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    size, group, shard, unit = apart(docs.columns, "size", "shard_group", "shard", "unit")
    text = whole(text_col)
    sized = docs.withColumn(size, (F.octet_length(text) + overhead).cast("long")).withColumn(
        group, F.concat_ws("-", F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("second"), text)))
    )
    groups = stage(sized.groupBy(F.col(group).alias("g")).agg(F.sum(size).alias("n")), "shard-groups")
    total = groups.agg(F.sum("n")).first()[0] or 0
    least = max(1, total // (shards * PER_SHARD))
    bundle = lambda g: F.concat(F.lit("b"), F.pmod(F.xxhash64(g), F.lit(shards * BUNDLES_PER_SHARD)))
    units = groups.groupBy(F.when(F.col("n") >= least, F.col("g")).otherwise(bundle(F.col("g"))).alias("u")).agg(
        F.sum("n").alias("n")
    )
    plan = longest_first(((r.u, r.n) for r in units.collect()), shards)
    schema = T.StructType([T.StructField(unit, T.StringType()), T.StructField(shard, T.IntegerType())])
    alone = F.broadcast(spark.createDataFrame([(u, s) for u, s in plan.items() if u[0] != "b"], schema))
    shared = F.broadcast(
        spark.createDataFrame([(u, s) for u, s in plan.items() if u[0] == "b"], schema).select(
            F.col(unit).alias(f"{unit}_b"), F.col(shard).alias(f"{shard}_b")
        )
    )
    return (
        sized.join(alone, sized[group] == alone[unit], "left")
        .join(shared, bundle(F.col(group)) == F.col(f"{unit}_b"), "left")
        .withColumn(shard, F.coalesce(F.col(shard), F.col(f"{shard}_b")))
        .drop(unit, f"{unit}_b", f"{shard}_b")
    )


def placed(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, size, text_crc32, law, shard, slot (gapless from 0 in a shard), grown_shard.

    The law is `bytes`, so grown_shard is null. Slots follow no meaning but are the same in each run.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = shard_by_bytes(rows, shards).select(
        "id", "size", F.crc32(whole("text").cast("binary")).alias("text_crc32"), "shard"
    )
    rows = stage(rows, "shards")
    numbered = number_within(rows, "shard", ["id", "text_crc32", "size"], "slot", rows.count())
    return numbered.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
