"""From raw documents to training shards: five stages, each an operator of the package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontamination, mixing, sharding, simhash, toxicity
from tickloom.llm.common import apart, stage, table

#: Columns of the documents that every stage but the last returns.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay. The model is fitted on labelled documents among those given.

    Where no term was learned nothing tells documents apart, and all stay. Null and empty texts have no hits and are
    scored as such; repeated rows score alike, so ties go or stay together; all columns come back as they are.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    (score,) = apart(docs.columns, "score")
    model = toxicity.fit(docs, labels)
    if not model[0]:
        return docs
    return toxicity.with_score(docs, model, score).where(f"{score} < 0.5").drop(score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the one with the smallest doc_id.

    Null and empty texts have fingerprint zero and are one group; of rows that repeat the smallest doc_id one stays, and
    rows without a doc_id stay only where their group has no other. All columns come back as they are.
    """
    return simhash.one_of_each(docs, shingle=4, radius=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, within its edits, go.

    Null and empty texts hold none, and null or empty items are in no text. Rows are judged by their text alone, so
    repeated rows go or stay together; all columns come back as they are.
    """
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a document that the mix takes less than half of goes.

    Null sources are a source of their own. Null and empty texts have no words and stay once. Repeated rows are
    documents of their own, in the seeded order; all columns come back as they are.
    """
    mixed = mixing.mix(docs)
    size, _, _, taken = mixed.columns[-4:]
    return mixing.repeated(mixed, size, taken).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies with their shard: equal texts on one, sizes near equal.

    Null and empty texts are one group, of 8 bytes a row. Two columns are added, under names that the documents do not
    have; all others come back as they are.
    """
    placed = sharding.shard_by_bytes(docs)
    size, _, number = placed.columns[-3:]
    return placed.select(*docs.columns, size, number)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: SQL has no counterpart of the first three stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
