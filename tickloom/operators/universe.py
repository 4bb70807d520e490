"""Daily universe: notional per symbol and its rank."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import not_nan
from tickloom.schemas import UNIVERSE


def daily_notional(bars: DataFrame, day: Column | str = "date") -> DataFrame:
    """``(date, symbol, notional)``: last close of the day times its total volume.

    Volume and last close come from one aggregate with partial results on the map side.
    The last close counts even when it is null; null symbols form no group.
    """
    volume = F.col("volume") if "volume" in bars.columns else F.lit(0)
    day = F.col(day) if isinstance(day, str) else day
    return (
        bars.where(F.col("symbol").isNotNull())
        .select(day.alias("date"), "symbol", "timestamp", "close", volume.alias("volume"))
        .groupBy("date", "symbol")
        .agg(
            F.max_by("close", "timestamp").alias("last_close"),
            F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
        )
        .select(
            "date",
            "symbol",
            not_nan(F.col("last_close") * F.col("total_volume").cast("double")).alias("notional"),
        )
    )


#: A group of more rows is cut into bands, at quantiles that a sketch of its values gives.
LARGE = 10_000
BANDS, ACCURACY = 64, 1_000
#: Rows that share one value, as two quantiles and more do, are cut by the tie's first characters.
TIE_CHARACTERS = 4


def rank_descending(
    df: DataFrame, group: str, value: str, tie: str, name: str, large: int = LARGE
) -> DataFrame:
    """Exact rank of a double within a group, largest first, ties by ``tie``, null for null.

    One window over the group would put a whole day on one task. A group of more than ``large``
    rows is cut into bands of about equal size: the edges are quantiles from a sketch, one pass
    with partial results on the map side. Rows are ranked within a band, and the number of rows
    in higher bands is added, which makes the rank exact however rough the edges are. A value so
    common that it is several edges at once has bands of its own, one for each beginning of the
    tie column, which follow the tie order; nulls, which need no order, are cut by a hash of it.

    The rows are read three times: for the sketch, for the sizes of the bands, and for the
    ranks. If they come out of an aggregate, as notionals do, its exchange serves all three.
    """
    v = F.col(value)
    quantiles = [i / BANDS for i in range(1, BANDS)]
    edges = df.groupBy(F.col(group).alias("_of")).agg(
        F.count(value).alias("_n"), F.percentile_approx(value, quantiles, ACCURACY).alias("_edges")
    )
    edges = edges.where(F.col("_n") > large).select("_of", "_edges")
    cut = df.join(edges, F.col(group).eqNullSafe(F.col("_of")), "left")
    no_edges = F.array().cast("array<double>")
    cut = cut.withColumn("_edges", F.when(v.isNotNull(), F.coalesce("_edges", no_edges)))
    above_v = F.size(F.filter("_edges", lambda x: x > v))
    shared = F.size(F.filter("_edges", lambda x: x == v)) > 1
    banded = cut.withColumns(
        {
            # of rows below the same edges, those with a common value are the lowest
            "_cut": F.when(v.isNotNull(), above_v * 2 + shared.cast("int")).otherwise(
                -1 - F.pmod(F.hash(tie), F.lit(1024))
            ),
            "_head": F.when(shared, F.substring(tie, 1, TIE_CHARACTERS)).otherwise(F.lit("")),
        }
    ).drop("_of", "_edges")
    band = [group, "_cut", "_head"]
    higher = Window.partitionBy(group).orderBy("_cut", "_head")
    above = F.sum("_rows").over(higher.rowsBetween(Window.unboundedPreceding, -1))
    bands = (
        banded.where(v.isNotNull())
        .groupBy(*band)
        .agg(F.count("*").alias("_rows"))
        .select(*[F.col(c).alias(f"{c}_in") for c in band], F.coalesce(above, F.lit(0)).alias("_above"))
    )
    same = [F.col(c).eqNullSafe(F.col(f"{c}_in")) for c in band]
    within = Window.partitionBy(*band).orderBy(v.desc(), F.col(tie))
    ranked = banded.withColumn("_row", F.row_number().over(within)).join(bands, same, "left")
    rank = F.when(v.isNotNull(), F.col("_row") + F.col("_above")).cast("bigint")
    return ranked.select(*df.columns, rank.alias(name))


def build_universe(bars: DataFrame, day: Column | str = "date") -> DataFrame:
    """Universe snapshots of all days at once: ``(date, symbol, notional, rank)``.

    ``day`` is the trading day of a bar (from its source file, or its UTC date). Bars are
    expected to be deduplicated. No bars give an empty frame of the same columns.
    """
    notional = daily_notional(bars, day)
    return rank_descending(notional, "date", "notional", "symbol", "rank").select(*UNIVERSE.names)


def top_symbols(universe: DataFrame, day: date, top_n: int | None = None) -> DataFrame:
    """Symbols of one day by notional, largest first; all of them without ``top_n``.

    The order follows the values, not a stored rank: a snapshot merged from several runs
    may carry ranks of more than one run.
    """
    picked = (
        universe.where(F.col("date") == F.lit(day))
        .select("symbol", "notional")
        .orderBy(F.col("notional").desc_nulls_last(), "symbol")
    )
    return picked if top_n is None else picked.limit(top_n)


def top_symbols_by_day(universe: DataFrame, top_n: int) -> DataFrame:
    """The first ``top_n`` ranks of every day."""
    return universe.where(F.col("rank") <= top_n)


def top_notional(bars: DataFrame, top_n: int, day: Column | str = "date") -> DataFrame:
    """``(date, symbol, notional, rank)`` of the first ``top_n`` symbols of every day, without
    ranking the others.

    Spark turns a ``rank <= n`` over a window into a limit per group: a task keeps at most
    ``top_n`` rows of a day before they are exchanged, so a day costs ``top_n`` rows a task
    however many symbols it has (up to the 1,000 of
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it the rows of a day are all
    exchanged). Symbols without a notional come last and have no rank.
    """
    best = Window.partitionBy("date").orderBy(F.col("notional").desc_nulls_last(), "symbol")
    first = daily_notional(bars, day).withColumn("rank", F.row_number().over(best))
    rank = F.when(F.col("notional").isNotNull(), F.col("rank")).cast("bigint")
    return first.where(F.col("rank") <= top_n).withColumn("rank", rank).select(*UNIVERSE.names)
