"""Exact dedup: digest runs merged in a tree."""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACE, apart, stage, whole

#: Runs that meet in one round of the tree.
FAN_IN = 8


def normalised(text: Column | str) -> Column:
    """Each stretch of white space as one space; null as empty."""
    return F.regexp_replace(whole(text), f"{SPACE}+", " ")


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its identifier, digest, proof of equality and the run it lies in.

    A run is what one scan task holds. The proof is a second hash and the length of the same text;
    rows whose digest agrees and whose proof does not are never merged.
    """
    text = F.col("text")
    return (
        docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"))
        .select(
            "id",
            F.sha2(text, 256).alias("digest"),
            F.struct(F.xxhash64(text).alias("hash"), F.octet_length(text).alias("bytes")).alias("proof"),
        )
        .withColumn("run", F.spark_partition_id())
    )


def merge_runs(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """Merge runs in rounds until one is left: digest, proof, keep_id, group_size.

    In round r the runs whose numbers share all but their last r digits (base `fan_in`) meet. A merge is a sort
    aggregate, which the struct of the identifier calls for: each task sorts its part of a run by digest and collapses
    equal neighbours before it sends them, and what arrives is merged in order and collapsed again, on disk where
    memory ends. It keeps the smallest identifier and the number of rows of a digest with equal proof, so a group of
    copies is one row per run from the first round on. The runs of a merge are dealt by digest, so that no task sees
    a whole run of the corpus.
    """
    level = runs.select("run", "digest", "proof", _who("id"), F.lit(1).cast("long").alias("rows"))
    for _ in range(max(1, ceil(log(max(n_runs, 1), fan_in) - 1e-9)) + 1):
        level = level.groupBy("run", "digest", "proof").agg(F.min("who").alias("who"), F.sum("rows").alias("rows"))
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
    return level.select("digest", "proof", F.col("who.id").alias("keep_id"), F.col("rows").alias("group_size"))


def _who(id_col: str) -> Column:
    """An identifier in an order that puts null last."""
    return F.struct(F.col(id_col).isNull().alias("nameless"), F.col(id_col).alias("id")).alias("who")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: its id column, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are copies of each other. Null identifiers never stay where the group
    has another; rows that repeat the smallest identifier share its decision (they are one document). Other columns
    are not read. An empty table gives an empty result.
    """
    return _decided(docs, id_col, text_col, fan_in).select(
        F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


def _decided(docs: DataFrame, id_col: str, text_col: str, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: digest, proof, id, keep_id, group_size, kept."""
    runs = stage(digest_runs(docs, id_col, text_col), "digests")
    n_runs = (runs.agg(F.max("run")).first()[0] or 0) + 1
    groups = merge_runs(runs, n_runs, fan_in)
    return runs.join(groups, ["digest", "proof"]).select(
        "digest", "proof", "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns.

    A row goes by its identifier and its own text: other texts under the same or no identifier stay.
    """
    gone = _decided(docs, id_col, text_col).where(~F.col("kept")).select("id", "digest", "proof").distinct()
    name, digest, proof = apart(docs.columns, "gone", "digest", "proof")
    gone = gone.toDF(name, digest, proof)
    text = normalised(docs[text_col])
    same = (
        docs[id_col].eqNullSafe(gone[name])
        & (F.sha2(text, 256) == gone[digest])
        & (F.xxhash64(text) == gone[proof]["hash"])
        & (F.octet_length(text) == gone[proof]["bytes"])
    )
    return docs.join(gone, same, "left_anti")
