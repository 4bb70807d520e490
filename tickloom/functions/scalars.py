"""Small column helpers shared by the operators."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def require_utc(spark: SparkSession) -> None:
    """Bars are UTC; a session in another zone would shift every date derived from them."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT", "+00:00"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC (is {zone})")


def to_utc(value: datetime) -> datetime:
    """Naive datetimes are taken as UTC, aware ones are converted."""
    if value.tzinfo is None:
        return value.replace(tzinfo=UTC)
    return value.astimezone(UTC)


def instant(value: datetime) -> Column:
    """Timestamp literal that does not depend on the driver's own time zone."""
    return F.timestamp_micros(F.lit(to_micros(value)))


def to_micros(value: datetime) -> int:
    """Exact epoch microseconds of a datetime."""
    delta = to_utc(value) - datetime(1970, 1, 1, tzinfo=UTC)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def utc_date(value: datetime | date) -> date:
    """UTC calendar date of an instant; a date stays as it is."""
    return to_utc(value).date() if isinstance(value, datetime) else value


def not_nan(c: Column) -> Column:
    """NaN to null: Spark orders NaN above every number, so it must go before a compare."""
    return F.when(~F.isnan(c), c)


def finite(c: Column) -> Column:
    """NaN and both infinities to null."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def number(name: str | Column) -> Column:
    """Lenient number: text that is no number becomes null, as does NaN."""
    c = F.col(name) if isinstance(name, str) else name
    return not_nan(c.try_cast("double"))


def quotient(a: Column, b: Column) -> Column:
    """a / b as floating point has it, where ANSI mode would fail: a number over zero is infinite,
    zero over zero NaN."""
    return F.when(b == 0, a * F.lit(float("inf"))).otherwise(F.try_divide(a, b))


def freq_checked(freq: str) -> str:
    """Only daily and one-minute bars exist."""
    if freq not in ("1d", "1min"):
        raise ValueError(f"Unsupported frequency: {freq}. Use 1d or 1min.")
    return freq


def in_range(d: Column, start: date | None, end: date | None) -> Column:
    """Whether a date lies between two inclusive bounds; without one it is open there."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.lit(start))
    if end is not None:
        cond = cond & (d <= F.lit(end))
    return cond
