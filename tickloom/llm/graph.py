"""Connected components of links, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import stage


def _least_neighbour(links: DataFrame) -> DataFrame:
    """(u, m); dealt anew, so that a join on u has its own exchange, whose hot partitions Spark can split."""
    return links.groupBy("u").agg(F.min("v").alias("m")).repartition(F.xxhash64("u"))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node that has a link (columns u, v): root is the smallest node of its component.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked to the node's least
    neighbour, then every smaller one is. Links only shrink towards stars around the roots; the number of rounds grows
    with the logarithm of the longest path. The least neighbour is an aggregate, so that a node with very many links
    is never gathered in one place.
    """
    links = stage(
        links.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    seen = None
    while (state := _state(links)) != seen and state[0]:
        seen = state
        both = links.union(links.select("v", "u"))
        least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        least = _least_neighbour(large)
        small = large.join(least, "u")
        moved = small.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stage(moved.union(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
