"""Bars in buckets by symbol, and what a lookup of few symbols reads."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import table
from tickloom.plans.prices import load_adjusted_prices, load_adjusted_volumes, load_prices
from tickloom.sinks import lake as sink
from tickloom.sources.lake import (
    BY_SYMBOL,
    Lake,
    bucket_table,
    scan_bars,
    scan_bars_by_symbol,
    symbol_layout,
)

SPAN = (datetime(2024, 1, 1), datetime(2024, 12, 31))
SYMBOLS = [f"S{i}" for i in range(12)]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def daily(spark, days, symbols=SYMBOLS):
    """Bars of every symbol on the first days of 2024; a symbol misses each seventh."""
    rows = spark.range(days * len(symbols)).select(
        (F.col("id") / len(symbols)).cast("int").alias("d"),
        F.element_at(F.array(*[F.lit(s) for s in symbols]), (F.col("id") % len(symbols) + 1).cast("int")).alias("symbol"),
    )
    value = (F.col("d") * 10 + F.length("symbol")).cast("double")
    return rows.where((F.col("d") + F.xxhash64("symbol")) % 7 != 0).select(
        F.date_add(F.lit("2024-01-01").cast("date"), "d").cast("timestamp").alias("timestamp"), "symbol",
        *[value.alias(f) for f in ("open", "high", "low", "close", "vwap")],
        (value * 100).alias("volume"), F.lit(1).cast("bigint").alias("n_trades"),
    )


def events(spark, lake):
    splits = spark.createDataFrame(
        [(s, f"2024-01-{d:02d}", 1.0, 2.0) for s in SYMBOLS for d in (5, 20)],
        "symbol string, execution_date string, split_from double, split_to double",
    )
    sink.write_splits(lake, splits)
    cash = spark.createDataFrame([(s, "2024-01-11", 1.0) for s in SYMBOLS], "symbol string, ex_dividend_date string, cash_amount double")
    sink.write_dividends(lake, cash)
    sink.build_corporate_actions_tables(lake)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_both_layouts_give_the_same_panels(spark, lake):
    bars = daily(spark, 40)
    sink.write_bars(lake, bars.where("timestamp < '2024-01-15'"), "1d")
    sink.lay_out_by_symbol(lake, 4)
    events(spark, lake)
    sink.write_bars(lake, bars, "1d")
    sink.write_bars(lake, bars, "1d")
    for load, more in ((load_adjusted_prices, []), (load_adjusted_volumes, []), (load_prices, [["open", "volume"]])):
        by_date, by_symbol = (load(lake, "1d", SYMBOLS[:5], *SPAN, *more, layout=x) for x in ("date", "symbol"))
        assert by_symbol.columns == by_date.columns
        assert rows_of(by_symbol) == rows_of(by_date) and by_date.count() > 150


def test_a_daily_panel_over_buckets_does_not_exchange_the_bars(spark, lake):
    sink.write_bars(lake, daily(spark, 60), "1d")
    events(spark, lake)
    sink.lay_out_by_symbol(lake, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(load_adjusted_prices(lake, "1d", SYMBOLS, *SPAN, layout="symbol"))
        few = final_plan(load_adjusted_prices(lake, "1d", SYMBOLS[:1], *SPAN, layout="symbol"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "Join" not in plan
    kinds = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, \d+\), (\w+)", plan)
    # the grid and both action tables are dealt to the buckets; of the bars, only their distinct times move
    assert sorted(kinds) == sorted([("symbol", "REPARTITION_BY_NUM")] * 3 + [("timestamp", "ENSURE_REQUIREMENTS")])
    assert "Exchange" not in plan[: plan.index("Union")]
    assert "SelectedBucketsCount: 1 out of 8" in few


def test_a_catalog_that_does_not_know_the_layout_learns_it(spark, lake):
    sink.write_bars(lake, daily(spark, 5), "1d")
    sink.lay_out_by_symbol(lake, 4)
    spark.sql(f"DROP TABLE {bucket_table(spark, *symbol_layout(lake))}")
    bars, buckets = scan_bars_by_symbol(lake, datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert buckets == 4
    want = scan_bars(lake, "1d", datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert table(bars, "timestamp", "symbol", "close") == table(want, "timestamp", "symbol", "close")


def test_a_new_number_of_buckets_takes_the_place_of_the_old(spark, lake):
    assert symbol_layout(lake) is None
    with pytest.raises(FileNotFoundError, match="lay the daily bars out"):
        load_prices(lake, "1d", SYMBOLS, *SPAN, layout="symbol")
    sink.lay_out_by_symbol(lake, 2)
    assert scan_bars_by_symbol(lake)[0].count() == 0
    sink.write_bars(lake, daily(spark, 5), "1d")
    sink.lay_out_by_symbol(lake, 8)
    assert len(os.listdir(lake.path(BY_SYMBOL))) == 1 and symbol_layout(lake)[1] == 8
    assert scan_bars_by_symbol(lake)[0].count() == scan_bars(lake, "1d").count()
    # one that was never finished does not count
    os.makedirs(lake.path(BY_SYMBOL, "buckets-3-99999999999999999999"))
    assert symbol_layout(lake)[1] == 8


def test_a_merge_that_died_between_the_layouts_is_completed(spark, lake):
    sink.write_bars(lake, daily(spark, 5), "1d")
    sink.lay_out_by_symbol(lake, 4)
    later = daily(spark, 9)
    sink._append_by_symbol(lake, sink.unique_bars(later))
    sink.write_bars(lake, later, "1d")
    assert scan_bars_by_symbol(lake)[0].count() == scan_bars(lake, "1d").count() == later.count()


def test_minute_panels_and_wrong_layouts(spark, lake):
    with pytest.raises(ValueError, match="date or symbol"):
        load_prices(lake, "1d", SYMBOLS, *SPAN, layout="time")
    assert load_prices(lake, "1min", SYMBOLS, *SPAN, layout="symbol").count() == 0


def rows_read(df):
    """What the Parquet reader hands on, after row groups were left out and before any filter."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.executedPlan().collectLeaves() if "Adaptive" in plan.nodeName() else plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_few_row_groups(spark, lake):
    """Symbols with even numbers alone: one that is missing lies between those that are there."""
    names = F.format_string("S%06d", F.col("id") * 2).alias("symbol")
    stamp = F.lit("2024-01-02").cast("timestamp").alias("timestamp")
    one = [F.lit(1.0).alias(f) for f in ("open", "high", "low", "close", "vwap", "volume")]
    bars = spark.range(60_000).select(stamp, names, *one, F.lit(1).alias("n_trades"))
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", str(64 * 1024))
    conf.set("parquet.enable.dictionary", "false")  # else the dictionary tells as well what is there
    try:
        sink.write_bars(lake, bars, "1d")
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.enable.dictionary")
    stored = scan_bars(lake, "1d", *SPAN)
    assert rows_read(stored) == 60_000
    present, absent = (stored.where(F.col("symbol") == s) for s in ("S080000", "S080001"))
    assert present.count() == 1 and 0 < rows_read(present) < 10_000
    assert rows_read(absent) == 0
