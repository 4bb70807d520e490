"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import apart, stage, whole

#: The seeded order of a source is cut here: hexadecimal digits, so 4,096 parts.
PART_DIGITS = 3


def words(text: Column | str) -> Column:
    """Number of words, 0 for null."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def fill(sources: DataFrame, size: str, weight: str, total: str, most: float, out: str) -> DataFrame:
    """Share `total` by weight; a source stops at `most` times its size and its excess goes to the others by weight.

    Sources are taken in order of their cap for a unit of weight. Once the first k are at their cap, the level of the
    others is (total - caps so far) / (weight left); the first level that the next source can hold is the answer. A
    source gets its cap or level x weight. One window over a table of one row per source.
    """
    cap, ratio, level, at = apart(sources.columns, "cap", "ratio", "level", "at")
    order = Window.orderBy(ratio, size, "source_rank")
    before, onward = (
        order.rowsBetween(Window.unboundedPreceding, -1),
        order.rowsBetween(Window.currentRow, Window.unboundedFollowing),
    )
    everything = Window.partitionBy(F.lit(0))
    return (
        sources.withColumn(cap, F.col(size) * F.lit(float(most)))
        .withColumn(ratio, F.col(cap) / F.col(weight))
        .withColumn(
            at, (F.col(total) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))) / F.sum(weight).over(onward)
        )
        .withColumn(
            level,
            F.min(F.when(F.col(at) <= F.col(ratio), F.struct(ratio, size, "source_rank", at))).over(everything)[at],
        )
        .withColumn(
            out, F.when(F.col(ratio) >= F.col(level), F.col(level) * F.col(weight)).otherwise(F.col(cap))
        )
        .drop(cap, ratio, level, at)
    )


def plan_sources(docs: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """One row per source from (source, part, size): its words, target, whole epochs, and where the seeded order is cut.

    Parts before `cut` are taken once more, parts after it are not, and of part `cut` the first `cut_words` words.
    """
    parts = docs.groupBy("source", "part").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "mix-parts")
    rank = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        parts.groupBy("source")
        .agg(F.sum("n").alias("words"))
        .withColumn("source_rank", F.row_number().over(rank) - 1)
        .withColumn("weight", F.get(turn, F.pmod(F.col("source_rank"), F.lit(len(weights)))))
        .withColumn("total", F.sum("words").over(Window.partitionBy(F.lit(0))) * F.lit(float(share)))
    )
    goals = (
        fill(sources, "words", "weight", "total", most, "target")
        .withColumn("epochs", F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0))
        .withColumn("rest", F.floor(F.col("target") + 0.5) - F.col("epochs") * F.col("words"))
        .select(F.col("source").alias("s"), "words", "target", "epochs", "rest")
    )
    cut = F.min(F.when(F.col("before") + F.col("n") > F.col("rest"), F.struct("part", "before")))
    return (
        parts.join(goals, F.col("source").eqNullSafe(F.col("s")))
        .groupBy("s", "words", "target", "epochs", "rest")
        .agg(cut.alias("at"))
        .select(
            "s",
            "words",
            "target",
            "epochs",
            F.coalesce(F.col("at.part"), F.lit("~")).alias("cut"),
            (F.col("rest") - F.col("at.before")).alias("cut_words"),
        )
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: str = "mix-1",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The documents with size, source_size, target and taken (words the mix takes, repeats counted).

    Sources in code point order, null last (null is a source), take the weights in turn and share `share` times all
    words; see `fill`. Each document is repeated whole as often as the epochs of its source are whole. The rest of the
    target is dealt in an order seeded by the identifier: documents are taken once more, and the last one in part,
    so that a source's taken words are its target rounded. Rows with equal identifier, size and source are dealt in
    any order. Texts without words take nothing; an empty table gives an empty result. New columns get underscores
    before their names where the input has such a name.
    """
    size, source_size, target, taken, part, key, s, epochs, cut, cut_words = apart(
        docs.columns, "size", "source_size", "target", "taken", "part", "seeded", "s", "epochs", "cut", "cut_words"
    )
    docs = docs.withColumn(
        key, F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    ).withColumn(part, F.substring(key, 1, PART_DIGITS))
    docs = docs.withColumn(size, words(text_col))
    sources = plan_sources(
        docs.select(F.col(source_col).alias("source"), F.col(part).alias("part"), F.col(size).alias("size")),
        weights,
        share,
        most,
    )
    # staged, so that Spark knows its size and need not move the documents while it is small
    sources = stage(sources.toDF(s, source_size, target, epochs, cut, cut_words), "mix-sources")
    dealt = docs.join(sources, docs[source_col].eqNullSafe(sources[s]))
    off = dealt.where(F.col(part) != F.col(cut)).withColumn(
        taken, F.when(F.col(part) < F.col(cut), F.col(size)).otherwise(0)
    )
    order = Window.partitionBy(source_col, part).orderBy(key, id_col, size)
    upto = F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    on = dealt.where(F.col(part) == F.col(cut)).withColumn(
        taken, F.greatest(F.lit(0), F.least(F.col(size), F.col(cut_words) - upto + F.col(size)))
    )
    return (
        off.unionByName(on)
        .withColumn(taken, (F.col(epochs) * F.col(size) + F.col(taken)).cast("long"))
        .drop(part, key, s, epochs, cut, cut_words)
    )


def repeated(mixed: DataFrame, size: str = "size", taken: str = "taken") -> DataFrame:
    """One row per copy: each document as often as the mix takes it, a part of one half or more as a whole copy.

    Documents without words, which no target counts, stay once.
    """
    copies = F.when(F.col(size) == 0, 1).otherwise(F.floor(F.col(taken) / F.col(size) + 0.5).cast("int"))
    (copy,) = apart(mixed.columns, "copy")
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).drop(copy)
