import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import close_bars, table
from tickloom.operators import ledger as led
from tickloom.operators import sessions as ses
from tickloom.operators import universe as uni
from tickloom.plans.prices import get_universe
from tickloom.sinks import lake as sink
from tickloom.sources.lake import Lake, load_ledger, load_universe_snapshot

BARS = [
    ("2024-01-02 14:30", "AAA", 10.2, 100),
    ("2024-01-02 20:00", "AAA", 10.4, 150),
    ("2024-01-02 20:00", "BBB", 21.0, 200),
]


def snapshot(spark, rows):
    return uni.build_universe(close_bars(spark, rows), F.to_date("timestamp"))


def test_notional_is_last_close_times_volume(spark):
    got = {r.symbol: (r.notional, r.rank) for r in snapshot(spark, BARS).collect()}
    assert got == {"AAA": (10.4 * 250, 2), "BBB": (21.0 * 200, 1)}


def test_null_and_missing_values(spark):
    rows = [*BARS, ("2024-01-02 21:00", "AAA", None, 5), ("2024-01-02 21:00", None, 5.0, 5),
            ("2024-01-02 21:00", "CCC", 5.0, None), ("2024-01-03 21:00", "AAA", 1.0, 1)]
    got = table(snapshot(spark, rows), "date", "symbol", "notional", "rank")
    assert got == [
        ("2024-01-02", "AAA", None, None),
        ("2024-01-02", "BBB", 4200.0, 1),
        ("2024-01-02", "CCC", 0.0, 2),
        ("2024-01-03", "AAA", 1.0, 1),
    ]
    none = snapshot(spark, [])
    assert none.columns == ["date", "symbol", "notional", "rank"] and none.count() == 0
    bare = close_bars(spark, BARS).drop("volume")
    assert {r.notional for r in uni.build_universe(bare, F.to_date("timestamp")).collect()} == {0.0}


@pytest.mark.parametrize("large", [uni.LARGE, 100, 0])
def test_rank_matches_a_plain_sort(spark, large):
    """Bands, ties, zeros, negatives, infinities and nulls rank as one sort would."""
    rng = random.Random(7)
    pool = [0.0, -0.0, 1.0, 1.0, 2.5, 1e-300, 1e300, float("inf"), -3.0, -0.5, None, 7.0, 7.0000001]
    rows = [
        (day, f"{rng.choice('abXYZ~é')}{i}", rng.choice(pool) if i % 2 else rng.lognormvariate(3, 4))
        for day in ("d1", "d2")
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "day string, symbol string, v double")
    got = {
        (r.day, r.symbol): r.rank
        for r in uni.rank_descending(df, "day", "v", "symbol", "rank", large).collect()
    }
    for day in ("d1", "d2"):
        ranked = sorted(
            (r for r in rows if r[0] == day and r[2] is not None),
            key=lambda r: (-r[2], r[1].encode()),
        )
        want = {(day, r[1]): i + 1 for i, r in enumerate(ranked)}
        want |= {(day, r[1]): None for r in rows if r[0] == day and r[2] is None}
        assert {k: v for k, v in got.items() if k[0] == day} == want


def test_top_of_every_day_is_that_of_the_full_rank(spark):
    rng = random.Random(3)
    rows = [
        (f"2024-01-{d:02d} 15:00", f"s{i}", rng.choice([1.0, 2.0, 3.0, None]))
        for d in range(1, 9) for i in range(rng.randrange(1, 9))
    ]
    bars = close_bars(spark, rows)
    for n in (1, 3, 20):
        full = uni.build_universe(bars, F.to_date("timestamp"))
        # a day of few symbols with a notional is filled up with those that have none
        want = full.where(F.coalesce("rank", F.lit(0)) <= n).where("rank is not null")
        got = uni.top_notional(bars, n, F.to_date("timestamp"))
        cols = ("date", "symbol", "notional", "rank")
        assert table(got.where("rank is not null"), *cols) == table(want, *cols)
        sizes = {r.date: r["count"] for r in got.groupBy("date").count().collect()}
        assert sizes == {r.date: min(n, r["count"]) for r in full.groupBy("date").count().collect()}


def test_snapshot_is_stored_and_queried(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    day = date(2024, 1, 2)
    assert load_universe_snapshot(lake, day).columns == ["date", "symbol", "notional", "rank"]
    assert get_universe(lake, day).count() == 0
    sink.write_universe(lake, snapshot(spark, BARS))
    sink.write_universe(lake, snapshot(spark, BARS))
    assert load_universe_snapshot(lake, day).count() == 2
    assert [r.symbol for r in get_universe(lake, day, 1).collect()] == ["BBB"]
    assert [r.symbol for r in get_universe(lake, day).collect()] == ["BBB", "AAA"]


# ---------------------------------------------------------------- ledger


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def d(day, month=2):
    return date(2024, month, day)


def test_started_is_not_complete(lake):
    assert not led.is_complete(load_ledger(lake), d(2), "1d")
    sink.record(lake, d(2), "1d", "started")
    assert not led.is_complete(load_ledger(lake), d(2), "1d")
    sink.record(lake, d(2), "1d", "complete")
    assert led.is_complete(load_ledger(lake), d(2), "1d")
    assert not led.is_complete(load_ledger(lake), d(2), "1min")


def test_a_redo_is_open_again_but_not_missing(spark, lake):
    for status in ("started", "complete", "started"):
        sink.record(lake, d(2), "1d", status)
    log = load_ledger(lake)
    assert not led.is_complete(log, d(2), "1d")
    days = ses.trading_days(spark, d(1), d(2))
    assert table(led.missing_days(days, log, "1d"), "date") == [("2024-02-01",)]
    assert led.missing_days(days, log, "1min").count() == 2


def test_latest_complete_ignores_failed_days(lake):
    sink.record(lake, d(2), "1d", "complete")
    sink.record(lake, d(5), "1d", "failed")
    sink.record(lake, d(6), "1d", "complete")
    sink.record(lake, d(7), "1d", "failed")
    log = load_ledger(lake)
    assert led.latest_complete_date(log, "1d") == d(6)
    assert led.latest_complete_date(log, "1min") is None
    assert table(led.gap_report(log, "1d", d(8)), "date") == [
        ("2024-02-05",), ("2024-02-07",), ("2024-02-08",)
    ]


def test_tail_keeps_the_order(spark, lake):
    days = spark.createDataFrame([(d(2),), (d(5),)], "date date")
    sink.record_days(lake, "1d", {"started": days, "complete": days})
    sink.record(lake, d(2), "1d", "failed")
    got = [(r.date, r.status) for r in led.tail(load_ledger(lake), 4).collect()]
    assert got == [(d(2), "complete"), (d(5), "started"), (d(5), "complete"), (d(2), "failed")]
    assert led.tail(load_ledger(lake), 0).count() == led.tail(load_ledger(lake), -3).count() == 0
    assert load_ledger(lake).select("seq").distinct().count() == 5


def windows(lake, freqs, fallback, end):
    got = led.update_windows(load_ledger(lake), freqs, fallback, end)
    return sorted((r.freq, r.start, r.end) for r in got.collect())


def test_windows(lake):
    with pytest.raises(ValueError, match="fallback_start"):
        windows(lake, ["1d"], None, d(6))
    assert windows(lake, ["1d"], d(1), d(6)) == [("1d", d(1), d(6))]
    sink.record(lake, d(2), "1d", "complete")
    assert windows(lake, ["1d"], None, d(6)) == [("1d", d(5), d(6))]
    sink.record(lake, d(5), "1min", "complete")
    assert windows(lake, ["1d", "1min"], None, d(6)) == [("1d", d(5), d(6)), ("1min", d(6), d(6))]
    sink.record(lake, d(6), "1d", "complete")
    assert windows(lake, ["1d"], None, d(6)) == []
    report = led.window_report(load_ledger(lake), ["1d", "1min"], None, d(6))
    assert table(report, "freq", "latest_complete", "start", "status") == [
        ("1d", "2024-02-06", None, "already-current"),
        ("1min", "2024-02-05", "2024-02-06", "update"),
    ]
    first = led.earliest_start([r.start for r in led.update_windows(load_ledger(lake), ["1d", "1min"], None, d(9)).collect()])
    assert first == d(6)
    with pytest.raises(ValueError, match="Unsupported frequency"):
        windows(lake, ["1h"], None, d(6))


def test_default_end_is_the_previous_session(spark):
    assert led.default_update_end(spark, d(5)) == d(2)
