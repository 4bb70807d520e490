"""Ingestion ledger: an append-only event table and the plans read from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import calendar as cal
from tickloom.functions.scalars import freq_checked, instant
from tickloom.operators import sessions as ses

# Ledger states, in the order one day goes through them.
STARTED, COMPLETE, FAILED = "started", "complete", "failed"


def last_status(ledger: DataFrame) -> DataFrame:
    """``(date, freq, status, is_complete)`` by the last event of each day and frequency."""
    return (
        ledger.groupBy("date", "freq")
        .agg(F.max_by("status", "seq").alias("status"))
        .withColumn("is_complete", F.coalesce(F.col("status") == COMPLETE, F.lit(False)))
    )


def is_complete(ledger: DataFrame, day: date, freq: str) -> bool:
    """Whether the last event of one day and frequency says complete."""
    row = last_status(ledger.where((F.col("date") == F.lit(day)) & (F.col("freq") == freq))).first()
    return row is not None and row.is_complete


def missing_days(days: DataFrame, ledger: DataFrame, freq: str) -> DataFrame:
    """Days never completed for a frequency, ascending; any complete event counts, not only
    the last one."""
    done = ledger.where((F.col("freq") == freq) & (F.col("status") == COMPLETE))
    return days.join(done.select("date"), "date", "left_anti").orderBy("date")


def latest_complete(ledger: DataFrame) -> DataFrame:
    """``(freq, latest_complete)``, null where a frequency has no complete day."""
    complete = F.when(F.col("status") == COMPLETE, F.col("date"))
    return ledger.groupBy("freq").agg(F.max(complete).alias("latest_complete"))


def latest_complete_date(ledger: DataFrame, freq: str) -> date | None:
    """Latest complete day of one frequency."""
    row = latest_complete(ledger.where(F.col("freq") == freq)).first()
    return row.latest_complete if row else None


def tail(ledger: DataFrame, limit: int = 50) -> DataFrame:
    """The last events in order; a limit of zero or less gives none."""
    return ledger.orderBy(F.col("seq").desc()).limit(max(limit, 0)).orderBy("seq")


def default_update_end(spark: SparkSession, today: date | None = None) -> date:
    """The session before today (UTC)."""
    return ses.previous_trading_day(spark, today or datetime.now(UTC).date())


def window_report(
    ledger: DataFrame, freqs: list[str], fallback_start: date | None, end: date
) -> DataFrame:
    """One row per frequency: latest complete day, planned start and end, status.

    ``update`` rows start at the session after the latest complete day, or at the fallback
    where there is none. ``already-current`` rows have no window. ``needs-start`` marks a
    frequency with neither history nor fallback.
    """
    spark = ledger.sparkSession
    asked = spark.createDataFrame([(freq_checked(f),) for f in freqs], "freq string")
    rows = asked.join(latest_complete(ledger.where(F.col("freq").isin(freqs))), "freq", "left")
    start = F.coalesce(
        cal.strictly_next_session("latest_complete"), F.lit(fallback_start).cast("date")
    )
    rows = rows.withColumn("_start", start).withColumn("_open", F.col("_start") <= F.lit(end))
    return rows.select(
        "freq",
        "latest_complete",
        F.when(F.col("_open"), F.col("_start")).alias("start"),
        F.when(F.col("_open"), F.lit(end)).alias("end"),
        F.when(F.col("_open"), F.lit("update"))
        .when(F.col("_start").isNull(), F.lit("needs-start"))
        .otherwise(F.lit("already-current"))
        .alias("status"),
    )


def update_windows(
    ledger: DataFrame, freqs: list[str], fallback_start: date | None, end: date
) -> DataFrame:
    """Windows with work to do; raises for a frequency without history or fallback."""
    report = window_report(ledger, freqs, fallback_start, end)
    if fallback_start is None:
        lost = report.where(F.col("status") == "needs-start").select("freq").collect()
        if lost:
            raise ValueError(
                f"nothing was ingested yet at {lost[0].freq}: give a fallback_start"
            )
    return report.where(F.col("status") == "update").drop("status")


def earliest_start(starts: Sequence[date]) -> date | None:
    """The first start over the windows of an update (one per frequency), if there are any."""
    return min(starts, default=None)


def gap_report(ledger: DataFrame, freq: str, end: date) -> DataFrame:
    """Sessions between the first complete day and ``end`` that were never completed."""
    spark = ledger.sparkSession
    row = (
        ledger.where((F.col("freq") == freq) & (F.col("status") == COMPLETE))
        .agg(F.min("date").alias("d"))
        .first()
    )
    first = row.d if row.d is not None else end
    return missing_days(ses.sessions(spark, first, end).select("date"), ledger, freq)


def ledger_rows(events: DataFrame, freq: str, base_seq: int) -> DataFrame:
    """Number the events ``(date, status)`` of one batch.

    Numbers need no window over the batch: they follow from the day and the status, so a
    day's events keep their order and days ascend. Gaps in the numbering are harmless.
    """
    order = F.array_position(F.lit([STARTED, COMPLETE, FAILED]), F.col("status"))
    seq = F.lit(base_seq) + F.unix_date("date") * 4 + order
    return events.select(
        seq.cast("bigint").alias("seq"),
        "date",
        F.lit(freq).alias("freq"),
        "status",
        instant(datetime.now(UTC)).alias("updated_at"),
    )


def next_seq(ledger: DataFrame) -> int:
    """A number above every one in the ledger."""
    return (ledger.agg(F.max("seq").alias("s")).first().s or 0) + 1
