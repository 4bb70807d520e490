"""Physical plans: what is shuffled, reused and broadcast, and how hot keys spread."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.operators import merge, universe
from tickloom.operators.actions import apply_price_adjustments
from tickloom.operators.panel import adjusted_price_panel, price_panel
from tickloom.sinks import lake as sink
from tickloom.sources.lake import Lake, scan_bars

SPAN = (datetime(2024, 1, 2), datetime(2024, 1, 31))


@pytest.fixture
def big_joins(spark):
    """Joins as they are planned for large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def skewed_bars(spark):
    """January minutes of 20 symbols; HOT has a bar every minute, the others every 20th."""
    stamp = F.timestamp_seconds(F.lit(1704153600) + F.col("id") % 41760 * 60)
    symbol = F.when(F.col("id") < 41760, F.lit("HOT")).otherwise(
        F.concat(F.lit("S"), F.expr("cast(id div 41760 as string)"))
    )
    df = spark.range(41760 * 20).where((F.col("id") < 41760) | (F.col("id") % 20 == 0))
    one = F.lit(1.0)
    return df.select(
        stamp.alias("timestamp"), symbol.alias("symbol"),
        *[one.alias(f) for f in ("open", "high", "low", "close", "vwap")],
        F.lit(5).alias("volume"), F.lit(1).alias("n_trades"),
    )


SYMBOLS = ["HOT", *[f"S{i}" for i in range(1, 20)]]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_minute_panel_shuffles_bars_once(spark, tmp_path, big_joins):
    lake = Lake(spark, str(tmp_path))
    sink.write_bars(lake, skewed_bars(spark), "1min")
    actions = spark.range(40).select(
        F.date_add(F.lit(date(2024, 1, 2)), (F.col("id") % 20).cast("int")).alias("date"),
        F.lit("HOT").alias("symbol"),
    ).distinct()
    bars = scan_bars(lake, "1min", *SPAN)
    df = adjusted_price_panel(
        bars,
        actions.withColumn("split_ratio", F.lit(0.5)),
        actions.withColumn("cash_amount", F.lit(0.01)),
        "1min", SYMBOLS, *SPAN,
    )
    plan = final_plan(df)
    # Full bars: one exchange of their own, used a second time; the other full scan reads
    # symbols only, for the list of those present.
    assert plan.count("REPARTITION_BY_COL") == 2
    assert len(re.findall(r"ReusedExchange.*REPARTITION_BY_COL", plan)) == 1
    assert plan.count("FileScan parquet") == 2
    for absent in ("CartesianProduct", "NestedLoop", "SinglePartition", "Python"):
        assert absent not in plan
    # The only broadcast is the session bounds of the range.
    assert set(re.findall(r"BroadcastExchange \w+\(List\((.*?)\)", plan)) == {
        "input[0, date, false]"
    }


def test_hot_symbol_is_spread_over_its_sessions(spark, big_joins):
    df = price_panel(skewed_bars(spark), "1min", SYMBOLS, *SPAN)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = (
            df.where("symbol = 'HOT'").groupBy(F.spark_partition_id().alias("p"))
            .agg(F.count("*").alias("n")).collect()
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) == 4
    assert max(r.n for r in parts) < 0.6 * sum(r.n for r in parts)


def test_fixed_width_duplicates_use_the_hash_aggregate(spark):
    plan = final_plan(merge.drop_duplicates_keep_first(skewed_bars(spark), merge.BAR_KEY))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_rank_of_a_hot_day_is_spread(spark, big_joins):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("date"),
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"),
        F.exp(F.randn(3) * 2 + 10).alias("notional"),
    )
    df = universe.rank_descending(rows, "date", "notional", "symbol", "rank")
    hot = df.where("date = 'hot'")
    assert hot.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (20_000, 20_000)
    plan = final_plan(df)
    assert "hashpartitioning(date" in plan and "_cut" in plan
    windows = re.findall(r"Window \[row_number\(\) windowspecdefinition\((.*?)ASC", plan)
    assert windows and all("_cut" in w for w in windows)


def day_of_equal_values(spark):
    return spark.range(60_000).select(
        F.lit(date(2024, 1, 2)).alias("date"), F.format_string("S%05d", "id").alias("symbol"),
        F.when(F.col("id") % 4 == 0, F.rand(5)).otherwise(F.lit(7.0)).alias("notional"),
    )


def test_a_day_of_equal_values_is_split(spark, big_joins):
    """A value of three quarters of a large day, by the beginnings of its symbols."""
    df = universe.rank_descending(day_of_equal_values(spark), "date", "notional", "symbol", "rank")
    plan = final_plan(df)
    bands = re.search(r"Window \[row_number\(\) windowspecdefinition\((.*?) DESC", plan).group(1)
    assert "_cut" in bands and "_head" in bands
    assert df.agg(F.max("rank"), F.count_distinct("rank")).first()[:] == (60_000, 60_000)
    assert df.where("notional = 7").orderBy("rank").first().symbol == "S00001"


def test_a_wide_market_is_scanned_once(spark, tmp_path):
    trades = skewed_bars(spark).withColumn("date", F.to_date("timestamp"))
    trades.write.parquet(f"{tmp_path}/trades")
    df = universe.build_universe(spark.read.parquet(f"{tmp_path}/trades"))
    plan = final_plan(df)
    assert plan.count("FileScan parquet") == 1 and "ReusedExchange" in plan


def test_the_top_of_a_day_is_limited_before_the_exchange(spark, tmp_path):
    trades = skewed_bars(spark).withColumn("date", F.to_date("timestamp"))
    plan = final_plan(universe.top_notional(trades, 3))
    assert re.search(r"WindowGroupLimit \[date#\d+\].*3, Partial", plan)


def exchanged_columns(plan):
    """The hash exchanges of the final plan, with what they are keyed by."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\), (\w+)", plan)


def test_dense_daily_rows_are_exchanged_once(spark, big_joins):
    actions = spark.createDataFrame([("HOT", date(2024, 1, 3))], "symbol string, date date")
    df = adjusted_price_panel(
        skewed_bars(spark),
        actions.withColumn("split_ratio", F.lit(0.5)),
        actions.withColumn("cash_amount", F.lit(0.01)),
        "1d", SYMBOLS, *SPAN,
    )
    plan = final_plan(df)
    keys = exchanged_columns(plan)
    by_symbol = [how for key, how in keys if re.fullmatch(r"symbol#\d+", key)]
    assert by_symbol == ["REPARTITION_BY_COL"]
    # besides, only the distinct timestamps are exchanged
    assert all(re.fullmatch(r"(symbol|timestamp)#\d+", key) for key, _ in keys)
    assert "Join" not in plan


def test_adjustments_scan_the_panel_twice(spark, big_joins, tmp_path):
    prices = skewed_bars(spark).select("timestamp", "symbol", "close")
    prices.write.parquet(f"{tmp_path}/panel")
    panel = spark.read.parquet(f"{tmp_path}/panel")
    events = spark.createDataFrame([("HOT", date(2024, 1, 3))], "symbol string, date date")
    df = apply_price_adjustments(
        panel, events.withColumn("split_ratio", F.lit(0.5)), events.withColumn("cash_amount", F.lit(0.01))
    )
    assert final_plan(df).count("FileScan parquet") == 2
