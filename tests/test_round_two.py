"""Behaviour of ingestion and ranks that earlier rounds did not cover."""

import gzip
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.functions import calendar as cal
from tickloom.operators import normalize as norm
from tickloom.operators import panel
from tickloom.operators import universe as uni
from tickloom.plans import jobs
from tickloom.session import scratch_path
from tickloom.sinks import lake as sink
from tickloom.sources import lake as src
from tickloom.sources import raw
from tickloom.sources.lake import Lake
from tickloom.streaming.ingest import stream_bars

HEADER = ["ticker", "window_start", "open", "high", "low", "close", "volume", "transactions"]
SOURCE = jobs.RawSource("v")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def land(lake, day, rows, name="", header=HEADER, freq="1d"):
    folder = f"{raw.raw_root(lake.root, 'v', freq)}/{day:%Y/%m}/{day}"
    import os

    os.makedirs(folder, exist_ok=True)
    with gzip.open(f"{folder}/{name or day}.csv.gz", "wt") as out:
        out.write("\n".join([",".join(header), *[",".join(map(str, r)) for r in rows]]) + "\n")


def stamp(day, minute=0):
    return int(datetime(day.year, day.month, day.day, 15, minute).timestamp()) * 10**9


def bar(symbol, day, close, volume=10, minute=0, n="1"):
    return symbol, stamp(day, minute), close, close, close, close, volume, n


@pytest.mark.parametrize("limit", [1, 1000])
def test_snapshots_do_not_depend_on_the_files_of_a_batch(spark, lake, limit):
    day = date(2024, 1, 3)
    land(lake, day, [bar("A", day, 10, 50), bar("B", day, 30, 1)], f"{day}-1")
    land(lake, day, [bar("A", day, 11, 0, minute=5), bar("A", day, 10, 50)], f"{day}-2")
    run = stream_bars(lake, SOURCE, "1d", HEADER, scratch_path(spark, "offsets"), True, limit)
    run.awaitTermination()
    got = [(r.symbol, r.notional, r["rank"]) for r in src.load_universe(lake).orderBy("rank").collect()]
    assert got == [("A", 550.0, 1), ("B", 30.0, 2)]
    assert src.scan_bars(lake, "1d").count() == 3


def test_bars_without_a_stamp_are_left_out_however_often_they_come(spark, lake):
    rows = [(datetime(2024, 1, 2), "A", 1.0), (None, "B", 1.0)]
    bars = spark.createDataFrame(rows, "timestamp timestamp, symbol string, close double")
    for field in ("open", "high", "low", "vwap", "volume"):
        bars = bars.withColumn(field, F.lit(1.0))
    bars = bars.withColumn("n_trades", F.lit(1))
    for _ in range(3):
        sink.write_bars(lake, bars, "1d")
    assert [r.symbol for r in src.scan_bars(lake, "1d").collect()] == ["A"]


def test_counts_and_bad_cells(spark):
    raw_rows = [("f", "A", "1704207600", "1.5", "12.0"), ("f", "B", "1704207600", "x", "7"), ("f", "C", None, "2", "2.5"),
                ("g", "D", "1704207600", "1", "9007199254740993")]
    df = spark.createDataFrame(raw_rows, "file string, ticker string, t string, close string, n string")
    got = {r.symbol: (r.close, r.n_trades) for r in norm.normalize_bars(df, per="file").collect()}
    assert got == {"A": (1.5, 12), "B": (None, 7), "C": (2.0, None), "D": (1.0, 9007199254740993)}
    audit = {r.file: (r["rows"], r.without_timestamp, r.bad_numbers) for r in norm.bad_cells(df, "file").collect()}
    assert audit == {"f": (3, 1, 2), "g": (1, 0, 0)}


def test_a_bad_day_fails_alone(spark, lake):
    days = [date(2024, 1, d) for d in (2, 3, 4, 5)]
    for day in days:
        land(lake, day, [bar("A", day, 1)])
    land(lake, days[1], [("x",)], header=["nothing"])
    done = jobs.backfill_bars(lake, SOURCE, days[0], days[-1], "1d")
    assert done.failed == [days[1]] and list(done.errors) == [days[1]]
    assert done.ingested == [days[0], days[2], days[3]]
    assert src.scan_bars(lake, "1d").count() == 3
    with pytest.raises(Exception):
        jobs.backfill_bars(lake, SOURCE, days[0], days[-1], "1d", fail_fast=True)


def test_staging_is_removed_after_a_run(spark, lake, tmp_path, monkeypatch):
    import tickloom.session as session

    day = date(2024, 1, 2)
    land(lake, day, [bar("A", day, 1)])
    removed = []
    monkeypatch.setattr(session, "remove", lambda s, p, f=session.remove: (removed.append(p), f(s, p)))
    jobs.backfill_bars(lake, SOURCE, day, day, "1d")
    assert removed
    import os

    assert not any(os.path.exists(p.removeprefix("file:")) for p in removed)


def test_action_tables_survive_a_failed_rebuild(spark, lake):
    splits = spark.createDataFrame([("A", "2024-01-02", 1.0, 2.0)], "symbol string, execution_date string, split_from double, split_to double")
    sink.write_splits(lake, splits)
    sink.build_split_ratio_table(lake)
    bad = spark.range(1).select(F.raise_error(F.lit("broken")).cast("date").alias("date"), F.lit("A").alias("symbol"), F.lit(1.0).alias("split_ratio"))
    with pytest.raises(Exception, match="broken"):
        sink._replace(lake, bad, "split_ratios")
    assert src.load_split_ratio_table(lake).count() == 1
    sink.build_split_ratio_table(lake)
    assert src.load_split_ratio_table(lake).count() == 1


def test_dates_outside_the_calendar_have_no_answer(spark):
    days = spark.createDataFrame([(date(1985, 7, 1),), (date(2100, 7, 1),), (date(2024, 7, 1),), (None,)], "d date")
    got = days.select(cal.is_session("d"), cal.next_session("d"), cal.is_early_close("d"), cal.previous_sessions("d", 1)).collect()
    assert [tuple(r) for r in got[:2]] == [(None, None, None, None)] * 2
    assert tuple(got[2])[:2] == (True, date(2024, 7, 1)) and got[3][0] is False


def test_equal_values_are_ranked_in_many_groups(spark):
    n = 6000
    rows = spark.range(n).select(
        F.lit(date(2024, 1, 2)).alias("date"),
        F.concat(F.lit("S"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("symbol"),
        F.when(F.col("id") < 4000, 100.0).when(F.col("id") < 5500, 0.0).otherwise(F.col("id") / 50).alias("notional"),
    )
    ranked = uni.rank_descending(rows, "date", "notional", "symbol", "rank")
    got = [(r.notional, r.symbol) for r in ranked.orderBy("rank").collect()]
    assert got == sorted(((r.notional, r.symbol) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    assert [r["rank"] for r in ranked.orderBy("rank").collect()] == list(range(1, n + 1))


def test_a_wide_panel_has_as_many_columns_as_symbols(spark):
    n = 10_050
    long = spark.range(n).select(F.lit(datetime(2024, 1, 2)).alias("timestamp"), F.concat(F.lit("S"), F.col("id")).alias("symbol"), F.lit(1.0).alias("close"))
    assert len(panel.to_wide(long, ["close"], [f"S{i}" for i in range(n)]).columns) == n + 1


def test_stored_columns_come_back(spark, lake):
    records = spark.createDataFrame([("A", "2024-01-02", 1.0, "note")], "ticker string, ex_dividend_date string, cash_amount double, memo string")
    jobs.sync_corporate_actions(lake, records.selectExpr("ticker", "ex_dividend_date as execution_date", "1.0 as split_from", "2.0 as split_to", "memo"), records)
    assert src.load_dividends(lake).first().memo == src.load_splits(lake).first().memo == "note"
