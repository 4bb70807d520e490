from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import bars, close_bars, table
from tickloom.operators.panel import panel_request, price_panel, to_wide

DAY = (datetime(2024, 1, 2), datetime(2024, 1, 2, 23, 59))


def test_daily_panel_is_wide_by_symbol(spark):
    df = bars(
        spark,
        [
            ("2024-01-02 16:00:00", "MSFT", 200.0, 202.0, 198.0, 201.5, 201.0, 2000, 20),
            ("2024-01-02 16:00:00", "AAPL", 100.0, 101.0, 99.0, 100.5, 100.2, 1000, 10),
        ],
    )
    wide = to_wide(price_panel(df, "1d", ["AAPL", "MSFT"], *DAY, fields=["close"]))
    assert wide.columns == ["timestamp", "AAPL", "MSFT"]
    assert table(wide, "timestamp", "AAPL", "MSFT") == [("2024-01-02 16:00", 100.5, 201.5)]


def test_arguments_are_checked(spark):
    with pytest.raises(ValueError, match="symbols must be a non-empty list"):
        panel_request("1d", [], *DAY)
    with pytest.raises(ValueError, match="symbols must be a non-empty list"):
        panel_request("1h", [], *DAY, fields=["bad"])
    with pytest.raises(ValueError, match="Unsupported field: bad"):
        panel_request("1d", ["AAPL"], *DAY, fields=["bad"])
    with pytest.raises(ValueError, match="Unsupported frequency"):
        panel_request("1h", ["AAPL"], *DAY)
    assert panel_request("1d", ["AAPL"], *DAY).fields == ("close",)


def test_minutes_start_at_the_open_and_never_look_ahead(spark):
    df = close_bars(
        spark, [("2024-01-02 14:31:00", "AAPL", 100.5), ("2024-01-02 14:32:00", "AAPL", 101.0)]
    )
    out = price_panel(
        df, "1min", ["AAPL"], datetime(2024, 1, 2, 14, 30), datetime(2024, 1, 2, 14, 33)
    )
    assert table(out, "timestamp", "close") == [
        ("2024-01-02 14:30", None),
        ("2024-01-02 14:31", 100.5),
        ("2024-01-02 14:32", 101.0),
        ("2024-01-02 14:33", 101.0),
    ]


def test_volume_gaps_are_zero(spark):
    df = close_bars(spark, [("2024-01-02 14:31:00", "AAPL", 100.5, 1000)])
    out = price_panel(
        df,
        "1min",
        ["AAPL"],
        datetime(2024, 1, 2, 14, 30),
        datetime(2024, 1, 2, 14, 32),
        fields=["volume"],
    )
    assert table(out, "timestamp", "volume") == [
        ("2024-01-02 14:30", 0),
        ("2024-01-02 14:31", 1000),
        ("2024-01-02 14:32", 0),
    ]


def test_minutes_are_filled_across_sessions_and_without_off_session_bars(spark):
    df = close_bars(
        spark,
        [
            ("2024-01-04 20:58:00", "A", 10.0),
            ("2024-01-04 22:00:00", "A", 99.0),  # after the close: dropped before the fill
            ("2024-01-05 14:30:30", "A", 98.0),  # not on a minute: dropped as well
            ("2024-01-06 15:00:00", "A", 97.0),  # a Saturday
            ("2024-01-09 14:31:00", "A", 11.0),
        ],
    )
    out = price_panel(
        df, "1min", ["A"], datetime(2024, 1, 4, 20, 58), datetime(2024, 1, 9, 14, 32)
    )
    rows = dict(table(out, "timestamp", "close"))
    assert len(rows) == 2 + 390 + 390 + 3
    assert {v for k, v in rows.items() if k < "2024-01-09 14:31"} == {10.0}
    assert rows["2024-01-09 14:31"] == rows["2024-01-09 14:32"] == 11.0


def test_symbol_with_only_off_session_bars_is_present_and_null(spark):
    df = close_bars(
        spark, [("2024-01-04 15:00:00", "A", 1.0), ("2024-01-04 22:00:00", "B", 2.0)]
    )
    out = price_panel(
        df, "1min", ["A", "B", "C"], datetime(2024, 1, 4, 14, 59), datetime(2024, 1, 4, 23, 0)
    )
    by = {r.symbol: (r.n, r.v) for r in out.groupBy("symbol")
          .agg(F.count("*").alias("n"), F.count("close").alias("v")).collect()}
    assert by == {"A": (361, 360), "B": (361, 0)}


def test_null_prices_are_carried_over_per_field(spark):
    df = bars(
        spark,
        [
            ("2024-01-04 15:00:00", "A", 1.0, 1.0, 1.0, 1.0, 1.0, 5, 1),
            ("2024-01-04 15:01:00", "A", None, 2.0, 2.0, float("nan"), 2.0, None, 1),
        ],
    )
    out = price_panel(
        df,
        "1min",
        ["A"],
        datetime(2024, 1, 4, 15, 0),
        datetime(2024, 1, 4, 15, 2),
        fields=["open", "high", "close", "volume"],
    )
    assert table(out, "timestamp", "open", "high", "close", "volume")[1:] == [
        ("2024-01-04 15:01", 1.0, 2.0, 1.0, 0.0),
        ("2024-01-04 15:02", 1.0, 2.0, 1.0, 0.0),
    ]


def test_unfilled_panels_keep_their_gaps(spark):
    df = close_bars(spark, [("2024-01-04 15:00:00", "A", 1.0), ("2024-01-04 15:02:00", "A", 2.0)])
    span = (datetime(2024, 1, 4, 15, 0), datetime(2024, 1, 4, 15, 3))
    out = price_panel(df, "1min", ["A"], *span, fill_missing_bars=False)
    assert [r[1] for r in table(out, "timestamp", "close")] == [1.0, None, 2.0, None]
    daily = close_bars(
        spark,
        [("2024-01-04", "A", 1.0), ("2024-01-05", "B", 2.0), ("2024-01-08", "A", 3.0)],
    )
    span = (datetime(2024, 1, 1), datetime(2024, 1, 9))
    out = price_panel(daily, "1d", ["A", "B"], *span, fill_missing_bars=False)
    wide = to_wide(out)
    assert table(wide, "A", "B") == [(1.0, None), (3.0, None), (None, 2.0)]
    filled = to_wide(price_panel(daily, "1d", ["A", "B"], *span))
    assert [tuple(r) for r in filled.select("A", "B").collect()] == [
        (1.0, None), (1.0, 2.0), (3.0, 2.0)
    ]


def test_daily_grid_has_only_seen_timestamps_and_symbols(spark):
    df = close_bars(spark, [("2024-01-04", "A", 1.0), ("2024-02-01", "B", 2.0)])
    out = price_panel(df, "1d", ["A", "B", "Z"], datetime(2024, 1, 1), datetime(2024, 1, 31))
    assert table(out, "timestamp", "symbol", "close") == [("2024-01-04 00:00", "A", 1.0)]


def test_nothing_is_carried_in_from_before_the_start(spark):
    df = close_bars(spark, [("2024-01-03 15:00:00", "A", 1.0), ("2024-01-04 14:31:00", "A", 2.0)])
    out = price_panel(
        df, "1min", ["A"], datetime(2024, 1, 4, 14, 30), datetime(2024, 1, 4, 14, 31)
    )
    assert [r[1] for r in table(out, "timestamp", "close")] == [None, 2.0]


@pytest.mark.parametrize("freq", ["1d", "1min"])
def test_duplicates_raise_for_one_field_and_average_for_several(spark, freq):
    stamp = "2024-01-04 15:00:00"
    df = close_bars(spark, [(stamp, "A", 1.0, 10), (stamp, "A", 2.0, 20)])
    span = (datetime(2024, 1, 4, 15, 0), datetime(2024, 1, 4, 15, 0))
    with pytest.raises(Exception, match="Duplicate bar"):
        price_panel(df, freq, ["A"], *span).collect()
    out = price_panel(df, freq, ["A"], *span, fields=["close", "volume"])
    assert table(out, "close", "volume") == [(1.5, 15.0)]
    wide = to_wide(out)
    assert wide.columns == ["timestamp", "close_A", "volume_A"]


def test_rows_without_any_asked_value_vanish_from_multi_field_panels(spark):
    df = bars(
        spark,
        [
            ("2024-01-04", "A", 1.0, 1.0, 1.0, 1.0, 1.0, 5, 1),
            ("2024-01-05", "A", None, None, None, None, None, 7, 1),
            ("2024-01-05", "B", None, None, None, None, None, 7, 1),
        ],
    )
    span = (datetime(2024, 1, 1), datetime(2024, 1, 9))
    out = price_panel(df, "1d", ["A", "B"], *span, fields=["open", "close"])
    assert table(out, "timestamp", "symbol", "close") == [("2024-01-04 00:00", "A", 1.0)]
    one = price_panel(df, "1d", ["A", "B"], *span)
    assert one.count() == 4


def test_empty_range_gives_an_empty_long_frame(spark):
    df = close_bars(spark, [("2024-01-04 15:00:00", "A", 1.0)])
    for freq in ("1d", "1min"):
        out = price_panel(df, freq, ["A"], datetime(2020, 1, 1), datetime(2020, 1, 31))
        assert out.columns == ["timestamp", "symbol", "close"]
        assert out.count() == 0


def test_aware_bounds_are_converted(spark):
    from datetime import timedelta, timezone

    df = close_bars(spark, [("2024-01-04 15:00:00", "A", 1.0), ("2024-01-04 16:00:00", "A", 2.0)])
    zone = timezone(timedelta(hours=2))
    out = price_panel(
        df, "1d", ["A"], datetime(2024, 1, 4, 17, tzinfo=zone), datetime(2024, 1, 4, 17, tzinfo=zone)
    )
    assert table(out, "timestamp") == [("2024-01-04 15:00",)]


def test_early_close_ends_the_grid(spark):
    df = close_bars(spark, [("2024-11-29 15:00:00", "A", 1.0)])
    out = price_panel(df, "1min", ["A"], datetime(2024, 11, 29), datetime(2024, 11, 29, 23))
    stamps = [r[0] for r in table(out, "timestamp")]
    assert (stamps[0], stamps[-1]) == ("2024-11-29 14:30", "2024-11-29 17:59")


def test_other_session_zone_is_refused(spark):
    df = close_bars(spark, [("2024-01-04 15:00:00", "A", 1.0)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="timeZone to UTC"):
            price_panel(df, "1d", ["A"], datetime(2024, 1, 1), datetime(2024, 1, 31))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
