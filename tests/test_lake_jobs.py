import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import close_bars, table
from tickloom import load_adjusted_prices, load_adjusted_volumes, load_prices
from tickloom.operators import ledger as led
from tickloom.operators import sessions as ses
from tickloom.plans import jobs
from tickloom.sinks import lake as sink
from tickloom.sources import lake as src
from tickloom.sources import raw
from tickloom.sources.lake import Lake
from tickloom.sources.reference import read_records
from tickloom.streaming.ingest import stream_bars

HEADER = "ticker,volume,open,close,high,low,window_start,transactions"
NOON = {2: 1704193200, 3: 1704279600, 4: 1704366000, 5: 1704452400}  # 11:00 UTC, Jan 2024
SOURCE = jobs.RawSource("vendor")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def day_file(lake, day, rows, freq="1d", layout="primary", header=HEADER, ext="csv.gz"):
    root = raw.raw_root(lake.root, "vendor", freq)
    iso = f"2024-01-0{day}"
    folder = "2024/01" if layout == "primary" else f"2024/01/{iso}"
    from pathlib import Path

    path = Path(root) / folder / f"{iso}.{ext}"
    path.parent.mkdir(parents=True, exist_ok=True)
    text = "\n".join([header, *rows]) + "\n"
    path.write_bytes(gzip.compress(text.encode()) if ext.endswith("gz") else text.encode())
    return str(path)


def row(symbol, day, close, volume=100, minute=0):
    stamp = (NOON[day] + minute * 60) * 1_000_000_000
    return f"{symbol},{volume},{close},{close},{close},{close},{stamp},5"


def test_bars_are_partitioned_and_merged(spark, lake):
    rows = [("2023-12-29", "A", 1.0), ("2024-01-02", "A", 2.0), ("2024-01-02", "B", 3.0)]
    assert sink.write_bars(lake, close_bars(spark, rows), "1d") == ["year=2023", "year=2024"]
    again = close_bars(spark, [("2024-01-02", "A", 9.0), ("2024-01-03", "A", 4.0)])
    assert sink.write_bars(lake, again, "1d") == ["year=2024"]
    sink.write_bars(lake, again, "1d")
    got = table(src.scan_bars(lake, "1d"), "timestamp", "symbol", "close")
    assert [(r[1], r[2]) for r in got] == [("A", 1.0), ("A", 2.0), ("B", 3.0), ("A", 4.0)]
    with pytest.raises(ValueError, match="Unsupported frequency"):
        sink.write_bars(lake, again, "1h")
    with pytest.raises(ValueError, match="not a bar table"):
        sink.write_bars(lake, again.drop("vwap"), "1d")


def test_minutes_are_partitioned_by_utc_date(spark, lake):
    df = close_bars(spark, [("2024-01-02 09:30", "A", 1.0), ("2024-01-03 00:10", "A", 2.0)])
    assert sink.write_bars(lake, df.withColumn("note", F.lit("x")), "1min") == [
        "date=2024-01-02", "date=2024-01-03"
    ]
    assert table(src.scan_bars(lake, "1min", extras=True), "close", "note") == [
        (1.0, "x"), (2.0, "x")
    ]


def test_scan_prunes_partitions(spark, lake):
    df = close_bars(spark, [(f"2024-01-0{i} 15:00", "A", float(i)) for i in (2, 3, 4)])
    sink.write_bars(lake, df, "1min")
    scan = src.scan_bars(lake, "1min", datetime(2024, 1, 3), datetime(2024, 1, 3, 23)).where(
        "symbol = 'A'"
    ).select("close")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "EqualTo(symbol,A)" in plan and "GreaterThanOrEqual(timestamp" in plan
    assert "ReadSchema: struct<timestamp:timestamp,symbol:string,close:double>" in plan
    assert [r.close for r in scan.collect()] == [3.0]


def test_events_are_unique_by_symbol_and_date(spark, lake):
    one = spark.createDataFrame(
        [("A", "2024-01-02", 2, 1)] * 2,
        "symbol string, execution_date string, split_from int, split_to int",
    )
    sink.write_splits(lake, one)
    sink.write_splits(lake, one)
    assert src.load_splits(lake).count() == 1
    two = spark.createDataFrame(
        [("A", "2024-01-02", 0.24)] * 2,
        "symbol string, ex_dividend_date string, cash_amount double",
    )
    sink.write_dividends(lake, two)
    assert table(src.load_dividends(lake), "cash_amount") == [(0.24,)]


def test_absent_tables_are_empty(lake):
    assert src.load_security_master(lake).columns == [
        "symbol", "name", "exchange", "type", "sector", "industry", "is_active"
    ]
    for load in (src.load_splits, src.load_dividends, src.load_ledger, src.load_universe,
                 src.load_split_ratio_table, src.load_dividend_cash_table,
                 src.load_security_master):
        assert load(lake).count() == 0
    sink.build_corporate_actions_tables(lake)
    assert src.load_split_ratio_table(lake).count() == 0


def test_prices_from_the_lake(spark, lake):
    df = close_bars(
        spark,
        [("2024-01-02", "AAA", 100.0, 1000), ("2024-01-03", "AAA", 120.0, 1200),
         ("2024-01-04", "AAA", 110.0, 1100), ("2024-01-03", "BBB", 5.0, 10)],
    )
    sink.write_bars(lake, df, "1d")
    sink.write_splits(lake, spark.createDataFrame(
        [("AAA", "2024-01-03", 1, 2), ("AAA", "2024-01-08", 1, 3)],
        "symbol string, execution_date string, split_from int, split_to int"))
    sink.write_dividends(lake, spark.createDataFrame(
        [("AAA", "2024-01-04", 1.0)],
        "symbol string, ex_dividend_date string, cash_amount double"))
    sink.build_corporate_actions_tables(lake)
    args = (lake, "1d", ["AAA"], datetime(2024, 1, 1), datetime(2024, 1, 31))
    step = 119.0 / 120.0
    got = table(load_adjusted_prices(*args), "timestamp", "close")
    assert [v for _, v in got] == [100.0 * 0.5 * step, 120.0 * step, 110.0]
    got = table(load_adjusted_volumes(*args), "timestamp", "volume")
    assert [v for _, v in got] == [2000.0, 1200.0, 1100.0]
    assert table(load_prices(*args), "close") == [(100.0,), (110.0,), (120.0,)]
    whole = load_prices(lake, "1d", ["AAA"], date(2024, 1, 2), date(2024, 1, 3))
    assert table(whole, "close") == [(100.0,), (120.0,)]
    # An earlier end of the range drops the later dividend from the adjustment.
    early = load_adjusted_prices(*args[:4], datetime(2024, 1, 3, 12))
    assert [v for _, v in table(early, "timestamp", "close")] == [50.0, 120.0]
    with pytest.raises(ValueError, match="Unsupported field"):
        load_adjusted_prices(*args, price_field="bad")


def test_raw_listing_prefers_the_primary_layout(spark, lake):
    day_file(lake, 2, [row("A", 2, 1.0)], layout="legacy")
    primary = day_file(lake, 2, [row("A", 2, 2.0)])
    legacy = day_file(lake, 3, [row("A", 3, 3.0)], layout="legacy")
    files = SOURCE.files(lake, "1d")
    assert [r.path.removeprefix("file:") for r in files.orderBy("date").collect()] == [
        primary, legacy
    ]
    days = ses.trading_days(spark, date(2024, 1, 2), date(2024, 1, 4))
    got = table(raw.audit_files(days, files), "date", "present", "files")
    assert got == [("2024-01-02", True, 1), ("2024-01-03", True, 1), ("2024-01-04", False, 0)]
    one = raw.fetch_day(spark, lake.root, "vendor", date(2024, 1, 2), "1d")
    assert table(one, "timestamp", "symbol", "close", "vwap", "n_trades") == [
        ("2024-01-02 11:00", "A", 2.0, 2.0, 5)
    ]
    with pytest.raises(FileNotFoundError, match="no raw file"):
        raw.fetch_day(spark, lake.root, "vendor", date(2024, 1, 5), "1d")


def test_paths_and_formats(spark, lake, tmp_path):
    assert raw.file_key("prefix", date(2024, 1, 2)) == "prefix/2024/01/2024-01-02.csv.gz"
    assert raw.dataset_for("1min", "us_stocks_sip/day_aggs_v1") == "us_stocks_sip/minute_aggs_v1"
    assert raw.dataset_for("1d", "other/day_aggs_v2") == "other/day_aggs_v2"
    with pytest.raises(ValueError, match="Unsupported frequency"):
        raw.dataset_for("1h")
    with pytest.raises(ValueError, match="no reader for x.txt"):
        raw.file_format("/a/x.txt")
    plain = day_file(lake, 2, [row("NA", 2, 1.0), row("TRUE", 2, 2.0)], ext="csv")
    assert table(raw.bars_from_files(spark, [plain]), "symbol", "close") == [
        ("NA", 1.0), ("TRUE", 2.0)
    ]
    parquet = str(tmp_path / "2024-01-02.parquet")
    close_bars(spark, [("2024-01-02", "A", 1.0)]).coalesce(1).write.parquet(parquet)
    assert raw.bars_from_files(spark, [parquet]).count() == 1


def test_files_with_another_header_fail(spark, lake):
    first = day_file(lake, 2, [row("A", 2, 1.0)])
    other = day_file(lake, 3, ["1,A,2"], header="v,ticker,window_start")
    with pytest.raises(Exception, match="(?i)header|schema"):
        raw.bars_from_files(spark, [first, other]).collect()


def backfill(lake, **kwargs):
    return jobs.backfill_bars(
        lake, SOURCE, date(2024, 1, 1), date(2024, 1, 7), "1d", **kwargs
    )


def test_backfill_takes_every_missing_day_in_one_run(spark, lake):
    day_file(lake, 2, [row("A", 2, 1.0), row("A", 2, 7.0), row("B", 2, 2.0, 50)])
    day_file(lake, 4, [row("A", 4, 3.0)], layout="legacy")
    day_file(lake, 5, [])
    done = backfill(lake, write_universe_snapshots=True)
    assert done.ingested == [date(2024, 1, d) for d in (2, 4, 5)]
    assert done.failed == [date(2024, 1, 3)]
    assert done.partitions == ["year=2024"]
    bars_read = src.scan_bars(lake, "1d")
    assert table(bars_read, "timestamp", "symbol", "close") == [
        ("2024-01-02 11:00", "A", 1.0), ("2024-01-02 11:00", "B", 2.0), ("2024-01-04 11:00", "A", 3.0)
    ]
    log = src.load_ledger(lake)
    assert led.is_complete(log, date(2024, 1, 2), "1d")
    assert not led.is_complete(log, date(2024, 1, 3), "1d")
    got = table(src.load_universe(lake), "date", "symbol", "notional", "rank")
    assert got == [("2024-01-02", "A", 100.0, 1), ("2024-01-02", "B", 100.0, 2),
                   ("2024-01-04", "A", 300.0, 1)]

    day_file(lake, 3, [row("A", 3, 2.5)])
    day_file(lake, 2, [row("A", 2, 99.0), row("C", 2, 99.0)])  # complete: not read again
    assert backfill(lake).ingested == [date(2024, 1, 3)]
    assert sorted(r[2] for r in table(src.scan_bars(lake, "1d"), "timestamp", "symbol", "close")
                  ) == [1.0, 2.0, 2.5, 3.0]
    assert backfill(lake) == jobs.BackfillResult([], [], [], [])


def test_backfill_in_several_runs(lake):
    for day in (2, 3, 4, 5):
        day_file(lake, day, [row("A", day, float(day))])
    done = backfill(lake, days_per_run=3)
    assert len(done.ingested) == 4 and done.partitions == ["year=2024"]
    assert src.scan_bars(lake, "1d").count() == 4
    assert src.load_ledger(lake).where("status = 'complete'").count() == 4


def test_backfill_of_some_symbols(lake):
    day_file(lake, 2, [row("A", 2, 1.0), row("B", 2, 2.0)])
    backfill(lake, symbols=["B"])
    assert table(src.scan_bars(lake, "1d"), "symbol") == [("B",)]


def test_backfill_stops_at_the_first_missing_file_if_asked(lake):
    day_file(lake, 2, [row("A", 2, 1.0)])
    day_file(lake, 4, [row("A", 4, 1.0)])
    with pytest.raises(FileNotFoundError, match="2024-01-03"):
        backfill(lake, fail_fast=True)
    status = {(str(r.date), r.status) for r in led.last_status(src.load_ledger(lake)).collect()}
    assert status == {("2024-01-02", "complete"), ("2024-01-03", "failed")}


def test_backfill_marks_days_failed_on_error(lake):
    day_file(lake, 2, ["x"], header="nothing")
    with pytest.raises(ValueError, match="feeds timestamp"):
        backfill(lake, fail_fast=True)
    assert not led.is_complete(src.load_ledger(lake), date(2024, 1, 2), "1d")
    rows = led.tail(src.load_ledger(lake), 1).collect()
    assert rows[0].status == "failed"


def reference(spark, tmp_path):
    def landed(name, records):
        path = tmp_path / f"{name}.json"
        path.write_text("\n".join(json.dumps(r) for r in records))
        return lambda: read_records(spark, str(path))

    return jobs.ReferenceSource(
        landed("tickers", [{"ticker": "A", "name": "Alpha", "primary_exchange": "XNYS",
                            "type": "CS", "active": True}]),
        landed("splits", [
            {"ticker": "A", "execution_date": "2024-01-03", "split_from": 1, "split_to": 2},
            {"ticker": "A", "execution_date": "2023-01-03", "split_from": 1, "split_to": 2}]),
        landed("dividends", [
            {"ticker": "A", "ex_dividend_date": "2024-01-04", "cash_amount": 0.5}]),
    )


def test_incremental_update(spark, lake, tmp_path):
    for day in (2, 3, 4):
        day_file(lake, day, [row("A", day, float(day))])
        day_file(lake, day, [row("A", day, float(day), minute=m) for m in (0, 1)], "1min")
    records = reference(spark, tmp_path)
    with pytest.raises(ValueError, match="fallback_start"):
        jobs.run_incremental_update(lake, SOURCE)

    def update(end, **kwargs):
        out = jobs.run_incremental_update(
            lake, SOURCE, fallback_start=date(2024, 1, 2), end=end, **kwargs
        )
        return [tuple(r) for r in out.collect()]

    first = update(date(2024, 1, 3), reference=records)
    assert first == [
        ("1d", date(2024, 1, 2), date(2024, 1, 3), 2, 2, 0, 1, True, date(2024, 1, 2)),
        ("1min", date(2024, 1, 2), date(2024, 1, 3), 2, 2, 0, 2, True, date(2024, 1, 2)),
    ]
    assert src.load_splits(lake).count() == 1
    assert src.load_dividends(lake).count() == 0
    assert table(src.load_split_ratio_table(lake), "split_ratio") == [(0.5,)]
    assert src.load_security_master(lake).count() == 1
    assert src.load_universe(lake).count() == 2

    second = update(date(2024, 1, 4), reference=records)
    assert [r[1] for r in second] == [date(2024, 1, 4)] * 2
    assert table(src.load_dividend_cash_table(lake), "cash_amount") == [(0.5,)]
    assert src.load_split_ratio_table(lake).count() == 1  # the earlier event stays

    assert update(date(2024, 1, 4)) == [(f, None, None, 0, 0, 0, 0, False, None) for f in ("1d", "1min")]
    assert src.scan_bars(lake, "1min").count() == 6


def test_stream_takes_new_files_once(spark, lake, tmp_path):
    def run():
        stream = stream_bars(
            lake, SOURCE, "1d", HEADER.split(","), str(tmp_path / "offsets"),
            write_universe_snapshots=True,
        )
        stream.awaitTermination()

    day_file(lake, 2, [row("A", 2, 1.0), row("A", 2, 7.0)])
    day_file(lake, 6, [row("A", 5, 1.0)])  # a Saturday's file is not ingested
    run()
    assert table(src.scan_bars(lake, "1d"), "close") == [(1.0,)]
    day_file(lake, 3, [row("A", 3, 2.0), row("B", 3, 3.0)])
    run()
    run()
    assert sorted(table(src.scan_bars(lake, "1d"), "close")) == [(1.0,), (2.0,), (3.0,)]
    log = src.load_ledger(lake)
    assert table(log, "date", "status") == [("2024-01-02", "complete"), ("2024-01-03", "complete")]
    assert src.load_universe(lake).count() == 3


def test_replayed_batch_changes_nothing(spark, lake, tmp_path):
    """A lost checkpoint replays every file; the merge keeps what is there."""
    day_file(lake, 2, [row("A", 2, 1.0)])
    for name in ("first", "second"):
        stream_bars(
            lake, SOURCE, "1d", HEADER.split(","), str(tmp_path / name)
        ).awaitTermination()
    assert src.scan_bars(lake, "1d").count() == 1
    assert src.load_ledger(lake).count() == 1


def test_foreign_lake_with_nanosecond_stamps(spark, tmp_path):
    import pandas as pd
    import pyarrow as pa
    import pyarrow.parquet as pq

    folder = tmp_path / "bars" / "freq=1d" / "year=2024"
    folder.mkdir(parents=True)
    frame = pa.table({
        "timestamp": pa.array([pd.Timestamp("2024-01-02 16:00")], pa.timestamp("ns", "UTC")),
        "symbol": ["A"],
        "close": [1.5],
    })
    pq.write_table(frame, folder / "2024.parquet", version="2.6")
    try:
        got = src.scan_foreign_bars(spark, str(tmp_path), "1d")
        assert table(got, "timestamp", "symbol", "close") == [("2024-01-02 16:00", "A", 1.5)]
    finally:
        spark.conf.unset("spark.sql.legacy.parquet.nanosAsLong")
