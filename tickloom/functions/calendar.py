"""NYSE trading calendar as native column expressions.

A session test is plain integer arithmetic on a date, so filtering a fact table to trading
days needs neither a join nor a broadcast and stays inside whole-stage codegen. The rules
cover 1993-2099; a date outside them has no answer (null).

Every function takes SQL text that yields a date (usually a column name) or a literal
date. The rules are kept as SQL text because one parsed expression is built much faster
than hundreds of column objects.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

EXCHANGE_ZONE = "America/New_York"
FIRST_DATE = date(1993, 1, 1)
LAST_DATE = date(2099, 12, 31)

# Unscheduled full-day closures since 1993 (public NYSE record).
SPECIAL_CLOSURES = (
    "1994-04-27",
    "2001-09-11",
    "2001-09-12",
    "2001-09-13",
    "2001-09-14",
    "2004-06-11",
    "2007-01-02",
    "2012-10-29",
    "2012-10-30",
    "2018-12-05",
    "2025-01-09",
)

# Unscheduled 13:00 closes since 1993 (public NYSE record).
SPECIAL_EARLY_CLOSES = ("1997-12-26", "1999-12-31", "2003-12-26")

# No run of closed days in the calendar is longer than this (tested over every year).
LONGEST_CLOSURE_DAYS = 10

# Spark numbers weekdays from Sunday = 1.
MON, TUE, WED, THU, FRI = 2, 3, 4, 5, 6


def _sql(d: str | date) -> str:
    return f"DATE'{d.isoformat()}'" if isinstance(d, date) else f"({d})"


def _on(d: str, month: int, day: int) -> str:
    return f"(month({d}) = {month} AND day({d}) = {day})"


def _observed(d: str, month: int, day: int) -> str:
    """A fixed-date holiday; Saturday moves to Friday, Sunday to Monday."""
    return (
        f"(month({d}) = {month} AND (day({d}) = {day}"
        f" OR (day({d}) = {day - 1} AND dayofweek({d}) = {FRI})"
        f" OR (day({d}) = {day + 1} AND dayofweek({d}) = {MON})))"
    )


def _nth(d: str, month: int, weekday: int, first: int, last: int) -> str:
    """A holiday on a weekday within a span of days of one month."""
    return (
        f"(month({d}) = {month} AND dayofweek({d}) = {weekday}"
        f" AND day({d}) BETWEEN {first} AND {last})"
    )


def _good_friday(d: str) -> str:
    """Friday before Easter, by Gauss's rule with its 1900-2099 constants."""
    moon = f"((year({d}) % 19 * 19 + 24) % 30)"
    week = f"((year({d}) % 4 * 2 + year({d}) % 7 * 4 + {moon} * 6 + 5) % 7)"
    late = f"({week} = 6 AND ({moon} = 29 OR ({moon} = 28 AND year({d}) % 19 > 10)))"
    shift = f"{moon} + {week} - CASE WHEN {late} THEN 7 ELSE 0 END"
    return (
        f"(month({d}) IN (3, 4) AND dayofweek({d}) = {FRI}"
        f" AND {d} = date_add(make_date(year({d}), 3, 20), {shift}))"
    )


def _listed(d: str, iso_dates: tuple[str, ...]) -> str:
    return f"{d} IN ({', '.join(f"DATE'{x}'" for x in iso_dates)})"


def _covered(d: str, answer: str) -> str:
    """The answer, or null for a date outside the years of the rules."""
    within = f"{d} BETWEEN DATE'{FIRST_DATE}' AND DATE'{LAST_DATE}'"
    return f"CASE WHEN {within} THEN {answer} END"


def _holiday(d: str) -> str:
    rules = [
        _on(d, 1, 1),
        f"({_on(d, 1, 2)} AND dayofweek({d}) = {MON})",
        f"({_nth(d, 1, MON, 15, 21)} AND year({d}) >= 1998)",
        _nth(d, 2, MON, 15, 21),
        _good_friday(d),
        _nth(d, 5, MON, 25, 31),
        f"({_observed(d, 6, 19)} AND year({d}) >= 2022)",
        _observed(d, 7, 4),
        _nth(d, 9, MON, 1, 7),
        _nth(d, 11, THU, 22, 28),
        _observed(d, 12, 25),
        _listed(d, SPECIAL_CLOSURES),
    ]
    return f"({' OR '.join(rules)})"


def _session(d: str) -> str:
    return f"coalesce(dayofweek({d}) BETWEEN {MON} AND {FRI} AND NOT {_holiday(d)}, false)"


def _early_close(d: str) -> str:
    """Early closes by date alone; on a non-session the answer does not matter."""
    before_july_4 = (
        f"({_on(d, 7, 3)} AND ((dayofweek({d}) IN ({MON}, {TUE}, {THU}) AND year({d}) >= 1995)"
        f" OR (dayofweek({d}) = {WED} AND year({d}) >= 2013)))"
    )
    rules = [
        before_july_4,
        f"({_on(d, 7, 5)} AND dayofweek({d}) = {FRI} AND year({d}) BETWEEN 1995 AND 2012)",
        f"({_nth(d, 11, FRI, 23, 29)} AND year({d}) >= 1993)",
        f"({_on(d, 12, 24)} AND year({d}) >= 1993)",
        _listed(d, SPECIAL_EARLY_CLOSES),
    ]
    return f"({' OR '.join(rules)})"


def _exchange_time(d: str, hour: str, minute: int) -> str:
    """Instant of a wall-clock time in the exchange's zone (DST aware)."""
    return (
        f"make_timestamp(year({d}), month({d}), day({d}), {hour}, {minute}, 0, '{EXCHANGE_ZONE}')"
    )


def _open(d: str) -> str:
    return _exchange_time(d, "9", 30)


def _close(d: str) -> str:
    return _exchange_time(d, f"CASE WHEN {_early_close(d)} THEN 13 ELSE 16 END", 0)


def is_holiday(d: str | date) -> Column:
    """Scheduled or unscheduled full-day closure (weekends not included)."""
    return F.expr(_covered(_sql(d), _holiday(_sql(d))))


def is_session(d: str | date) -> Column:
    """True where the date is a trading day; null dates are no sessions."""
    d = _sql(d)
    return F.expr(f"CASE WHEN {d} IS NULL THEN false ELSE {_covered(d, _session(d))} END")


def is_early_close(d: str | date) -> Column:
    """True on trading days that end at 13:00 exchange time."""
    d = _sql(d)
    return F.expr(_covered(d, f"({_session(d)} AND {_early_close(d)})"))


def session_open(d: str | date) -> Column:
    """Opening instant of a session; to be used on session dates only."""
    return F.expr(_covered(_sql(d), _open(_sql(d))))


def session_close(d: str | date) -> Column:
    """Closing instant of a session, early closes honoured; on session dates only."""
    return F.expr(_covered(_sql(d), _close(_sql(d))))


def minute_bounds(d: str | date, closed: str = "left") -> tuple[Column, Column]:
    """First and last session minute of a session date.

    ``closed`` says which of the open and the close belong to the session:
    ``left`` (default), ``right``, ``both`` or ``neither``.
    """
    if closed not in ("left", "right", "both", "neither"):
        raise ValueError(f"closed must be left, right, both or neither: {closed}")
    first, last = _open(_sql(d)), _close(_sql(d))
    if closed in ("right", "neither"):
        first = f"{first} + INTERVAL 1 MINUTE"
    if closed in ("left", "neither"):
        last = f"{last} - INTERVAL 1 MINUTE"
    return F.expr(first), F.expr(last)


def _first_session(days: str) -> str:
    return f"get(filter({days}, x -> {_session('x')}), 0)"


def next_session(d: str | date) -> Column:
    """The date itself when it is a session, otherwise the first one after it."""
    d = _sql(d)
    after = _first_session(f"sequence({d}, date_add({d}, {LONGEST_CLOSURE_DAYS}))")
    return F.expr(_covered(d, after))


def strictly_next_session(d: str | date) -> Column:
    """First session after the date."""
    return next_session(f"date_add({_sql(d)}, 1)")


def previous_session(d: str | date) -> Column:
    """Last session before the date."""
    d = _sql(d)
    back = f"sequence(date_sub({d}, 1), date_sub({d}, {1 + LONGEST_CLOSURE_DAYS}))"
    return F.expr(_covered(d, _first_session(back)))


def previous_sessions(d: str | date, n: int) -> Column:
    """Array of the ``n`` sessions before the date, newest first."""
    if n < 0:
        raise ValueError(f"the number of sessions cannot be negative: {n}")
    d = _sql(d)
    back = f"sequence(date_sub({d}, 1), date_sub({d}, {lookback_days(n)}))"
    return F.expr(_covered(d, f"slice(filter({back}, x -> {_session('x')}), 1, {n})"))


def lookback_days(n: int) -> int:
    """Calendar days that always hold at least ``n`` sessions."""
    return 2 * n + 2 * LONGEST_CLOSURE_DAYS


def check_range(start: date, end: date) -> None:
    """Refuse dates outside the years the rules describe."""
    if start < FIRST_DATE or end > LAST_DATE:
        raise ValueError(
            f"calendar covers {FIRST_DATE} to {LAST_DATE}, asked for {start} to {end}"
        )
