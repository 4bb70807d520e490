"""Trading-calendar tables and lookups as DataFrames."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import calendar as cal
from tickloom.functions.scalars import instant, require_utc, utc_date


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every calendar date in the range, one row each."""
    cal.check_range(start, end)
    days = (end - start).days + 1
    first = F.lit(start)
    return spark.range(max(days, 0)).select(
        F.date_add(first, F.col("id").cast("int")).alias("date")
    )


def sessions(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Session dimension ``(date, open_ts, close_ts)``; bounds inclusive."""
    return (
        calendar_days(spark, start, end)
        .where(cal.is_session("date"))
        .select(
            "date",
            cal.session_open("date").alias("open_ts"),
            cal.session_close("date").alias("close_ts"),
        )
    )


def trading_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Session dates in the range, ascending, bounds inclusive."""
    return calendar_days(spark, start, end).where(cal.is_session("date")).orderBy("date")


def trading_minutes(
    spark: SparkSession, start: datetime, end: datetime, closed: str = "left"
) -> DataFrame:
    """Session minutes between two instants, both inclusive; early closes honoured."""
    require_utc(spark)
    lo, hi = utc_date(start), utc_date(end)
    first, last = cal.minute_bounds("date", closed)
    return (
        calendar_days(spark, lo, hi)
        .where(cal.is_session("date"))
        .select(
            F.explode(F.sequence(first, last, F.expr("interval 1 minute"))).alias("timestamp"),
            F.col("date").alias("session_date"),
        )
        .where(F.col("timestamp").between(instant(start), instant(end)))
    )


def with_session_flag(df: DataFrame, date_col: str, name: str = "is_session") -> DataFrame:
    """Mark rows whose date is a trading day."""
    return df.withColumn(name, cal.is_session(date_col))


def only_sessions(df: DataFrame, date_col: str) -> DataFrame:
    """Keep rows whose date is a trading day."""
    return df.where(cal.is_session(date_col))


def _one_date(spark: SparkSession, value: Column) -> date:
    return spark.range(1).select(value.alias("d")).first().d


def is_trading_day(spark: SparkSession, day: date) -> bool:
    """Whether one date is a session."""
    cal.check_range(day, day)
    return spark.range(1).select(cal.is_session(day).alias("s")).first().s


def session_times(spark: SparkSession, day: date) -> tuple[datetime, datetime]:
    """Open and close of one session as aware UTC datetimes; error on other dates."""
    row = (
        sessions(spark, day, day)
        .select(F.unix_micros("open_ts").alias("o"), F.unix_micros("close_ts").alias("c"))
        .first()
    )
    if row is None:
        raise ValueError(f"{day} is not a trading day")
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    return epoch + timedelta(microseconds=row.o), epoch + timedelta(microseconds=row.c)


def next_trading_day(spark: SparkSession, day: date | None = None) -> date:
    """First session on or after a date (default: today in UTC)."""
    return _one_date(spark, cal.next_session(day or datetime.now(UTC).date()))


def strictly_next_trading_day(spark: SparkSession, day: date) -> date:
    """First session after a date."""
    return _one_date(spark, cal.strictly_next_session(day))


def previous_trading_day(spark: SparkSession, day: date) -> date:
    """Last session before a date."""
    return _one_date(spark, cal.previous_session(day))


def previous_n_trading_days(spark: SparkSession, day: date, n: int) -> DataFrame:
    """The ``n`` sessions before a date, newest first."""
    if n < 0:
        raise ValueError(f"the number of sessions cannot be negative: {n}")
    reach = timedelta(days=cal.lookback_days(n))
    return (
        calendar_days(spark, day - reach, day - timedelta(days=1))
        .where(cal.is_session("date"))
        .orderBy(F.col("date").desc())
        .limit(n)
    )
