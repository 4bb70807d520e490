from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickloom.functions import calendar as cal
from tickloom.operators import sessions as ses


def days(df):
    return [r.date for r in df.collect()]


def test_range_is_inclusive_and_skips_the_weekend(spark):
    got = days(ses.trading_days(spark, date(2024, 2, 1), date(2024, 2, 7)))
    assert got == [date(2024, 2, d) for d in (1, 2, 5, 6, 7)]


def test_session_flags(spark):
    assert not ses.is_trading_day(spark, date(2024, 2, 3))
    assert ses.is_trading_day(spark, date(2024, 2, 6))


def test_session_times_follow_daylight_saving(spark):
    assert ses.session_times(spark, date(2024, 2, 6)) == (
        datetime(2024, 2, 6, 14, 30, tzinfo=UTC),
        datetime(2024, 2, 6, 21, 0, tzinfo=UTC),
    )
    assert ses.session_times(spark, date(2024, 7, 1))[0].hour == 13
    with pytest.raises(ValueError, match="not a trading day"):
        ses.session_times(spark, date(2024, 2, 3))


def test_neighbours(spark):
    assert ses.next_trading_day(spark, date(2024, 2, 6)) == date(2024, 2, 6)
    assert ses.next_trading_day(spark, date(2024, 2, 3)) == date(2024, 2, 5)
    assert ses.strictly_next_trading_day(spark, date(2024, 2, 6)) == date(2024, 2, 7)
    assert ses.strictly_next_trading_day(spark, date(2024, 2, 3)) == date(2024, 2, 5)
    assert ses.previous_trading_day(spark, date(2024, 2, 5)) == date(2024, 2, 2)
    assert ses.next_trading_day(spark, date(2001, 9, 11)) == date(2001, 9, 17)
    assert ses.next_trading_day(spark) >= datetime.now(UTC).date()


def test_previous_n(spark):
    got = days(ses.previous_n_trading_days(spark, date(2024, 2, 6), 3))
    assert got == [date(2024, 2, 5), date(2024, 2, 2), date(2024, 2, 1)]
    assert days(ses.previous_n_trading_days(spark, date(2024, 2, 6), 0)) == []
    with pytest.raises(ValueError, match="cannot be negative"):
        ses.previous_n_trading_days(spark, date(2024, 2, 6), -1)
    array = spark.range(1).select(cal.previous_sessions(date(2024, 2, 6), 3).alias("a"))
    assert array.first().a == got


def test_minutes_per_session(spark):
    full = ses.trading_minutes(spark, datetime(2024, 2, 6), datetime(2024, 2, 6, 23, 59))
    assert full.count() == 390
    early = ses.trading_minutes(spark, datetime(2024, 11, 29), datetime(2024, 11, 29, 23, 59))
    assert early.count() == 210
    cut = ses.trading_minutes(spark, datetime(2024, 2, 6, 14, 30), datetime(2024, 2, 6, 14, 32))
    assert cut.count() == 3
    both = ses.trading_minutes(
        spark, datetime(2024, 2, 6), datetime(2024, 2, 6, 23, 59), closed="both"
    )
    assert both.count() == 391


# Published full-day closures of two years with moved holidays.
CLOSED = {
    2021: "01-01 01-18 02-15 04-02 05-31 07-05 09-06 11-25 12-24",
    2022: "01-17 02-21 04-15 05-30 06-20 07-04 09-05 11-24 12-26",
    2012: "01-02 01-16 02-20 04-06 05-28 07-04 09-03 10-29 10-30 11-22 12-25",
}


@pytest.mark.parametrize("year", CLOSED)
def test_closures_of_a_year(spark, year):
    all_days = ses.calendar_days(spark, date(year, 1, 1), date(year, 12, 31))
    closed = all_days.where(F.dayofweek("date").between(2, 6) & ~cal.is_session("date"))
    want = [date.fromisoformat(f"{year}-{d}") for d in CLOSED[year].split()]
    assert sorted(days(closed)) == want


def test_early_closes(spark):
    span = ses.calendar_days(spark, date(2024, 1, 1), date(2024, 12, 31))
    got = sorted(days(span.where(cal.is_early_close("date"))))
    assert got == [date(2024, 7, 3), date(2024, 11, 29), date(2024, 12, 24)]


def test_longest_closure_bounds_the_search(spark):
    rows = days(ses.trading_days(spark, cal.FIRST_DATE, cal.LAST_DATE))
    longest = max(b - a for a, b in zip(rows, rows[1:], strict=False))
    assert longest < timedelta(days=cal.LONGEST_CLOSURE_DAYS)
    easter = spark.range(1).select(cal.is_holiday(date(2049, 4, 16)).alias("h")).first().h
    assert easter


def test_range_outside_the_rules_is_refused(spark):
    with pytest.raises(ValueError, match="calendar covers"):
        ses.trading_days(spark, date(1980, 1, 1), date(1980, 2, 1))
