"""Daily universes as a stream that keeps state: a day is ranked once, when it is closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions.scalars import freq_checked, not_nan
from tickloom.operators.merge import BAR_KEY
from tickloom.operators.universe import rank_descending
from tickloom.schemas import UNIVERSE
from tickloom.sinks import lake as sink
from tickloom.sources.lake import Lake, bars_schema


def closed_days(bars: DataFrame, delay: str) -> DataFrame:
    """``(date, symbol, notional)`` of a stream of bars, each UTC day once, in append mode.

    A day is closed when the latest bar seen is ``delay`` past its end; bars that come later
    are left out. Until then the state holds one row per symbol and open day, and the keys of
    the bars of twice the delay before the latest, by which a bar that arrives twice counts once.
    Nothing older is kept, so the state follows the delay and not the length of the stream.
    """
    once = bars.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(list(BAR_KEY))
    days = once.where(F.col("symbol").isNotNull()).groupBy(F.window("timestamp", "1 day"), "symbol").agg(
        F.max_by("close", "timestamp").alias("last_close"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("double").alias("total_volume"),
    )
    return days.select(
        F.to_date("window.start").alias("date"),
        "symbol",
        not_nan(F.col("last_close") * F.col("total_volume")).alias("notional"),
    )


def stream_daily_universe(
    lake: Lake,
    freq: str,
    checkpoint: str,
    delay: str = "3 days",
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Rank the days of the stored bars as they close, then stop; the next run goes on there.

    The stream follows the files that merges add to the bar table, each once. All symbols of a
    day leave the state in one batch, which replaces the day's snapshot, so a batch that is
    repeated after a failure gives the same.
    """
    bars = (
        lake.spark.readStream.schema(bars_schema(freq_checked(freq)))
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(lake.bars_path(freq))
    )

    def rank(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            ranked = rank_descending(batch, "date", "notional", "symbol", "rank")
            sink.replace_universe(lake, ranked.select(*UNIVERSE.names))

    return (
        closed_days(bars, delay)
        .writeStream.foreachBatch(rank)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
