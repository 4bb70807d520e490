from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import bars, close_bars, table
from tickloom.operators import merge
from tickloom.operators import normalize as norm


def stamps(spark, values, kind="bigint"):
    raw = spark.createDataFrame([("A", v) for v in values], f"T string, t {kind}")
    out = norm.normalize_bars(raw)
    return sorted(r.s for r in out.select(F.col("timestamp").cast("string").alias("s")).collect())


def test_epoch_unit_follows_the_largest_value(spark):
    assert stamps(spark, [1704201600000000000]) == ["2024-01-02 13:20:00"]
    assert stamps(spark, [1704201600123456789]) == ["2024-01-02 13:20:00.123456"]
    assert stamps(spark, [1704201600000]) == ["2024-01-02 13:20:00"]
    assert stamps(spark, [1704201600]) == ["2024-01-02 13:20:00"]
    mixed = stamps(spark, [1704201600000, 1704201600000000000])
    assert mixed == ["1970-01-01 00:28:24.2016", "2024-01-02 13:20:00"]


def test_microseconds_are_a_unit_of_their_own(spark):
    assert stamps(spark, [1704201600123456]) == ["2024-01-02 13:20:00.123456"]
    raw = spark.createDataFrame([("A", 1704201600123456)], "ticker string, window_start bigint")
    old = norm.normalize_bars(raw, original_units=True)
    assert table(old, "timestamp") == [("1970-01-20 17:23",)]
    for stamp, year in ((-5, 1969), (10**8, 1973), (10**17 + 1, 1973), (10**14 + 1, 1973), (10**11 + 1, 1973)):
        assert stamps(spark, [stamp])[0].startswith(str(year))


def test_text_stamps(spark):
    assert stamps(spark, ["2024-01-02T13:20:00Z"], "string") == ["2024-01-02 13:20:00"]
    assert stamps(spark, ["2024-01-02 13:20:00+02:00"], "string") == ["2024-01-02 11:20:00"]
    assert stamps(spark, ["1704201600000000000"], "string") == ["2024-01-02 13:20:00"]
    assert stamps(spark, ["1.7042016E9"], "string") == ["2024-01-02 13:20:00"]


def test_unit_is_decided_per_file(spark):
    raw = spark.createDataFrame(
        [("A", 1704201600, "f1"), ("A", 1704201600000, "f2"), ("A", None, "f3")],
        "ticker string, window_start bigint, file string",
    )
    out = norm.normalize_bars(raw, per="file")
    assert table(out, "file", "timestamp") == [
        ("f1", "2024-01-02 13:20"), ("f2", "2024-01-02 13:20"), ("f3", None)
    ]


def test_short_names_and_defaults(spark):
    raw = spark.createDataFrame(
        [(1704201600, "NA", "1.5", "x")], "t bigint, T string, c string, note string"
    )
    out = norm.normalize_bars(raw)
    assert table(out, "symbol", "close", "vwap", "n_trades", "volume", "note") == [
        ("NA", 1.5, 1.5, 0, 0, "x")
    ]


def test_null_values_are_not_defaulted(spark):
    raw = spark.createDataFrame(
        [(1704201600, "A", 1.5, None, None)], "t bigint, T string, c double, vw double, v double"
    )
    assert table(norm.normalize_bars(raw), "vwap", "volume") == [(None, None)]


def test_bad_columns(spark):
    with pytest.raises(ValueError, match="feeds timestamp"):
        norm.canonical_names(["ticker", "close"])
    with pytest.raises(ValueError, match="feeds symbol"):
        norm.canonical_names(["t", "close"])
    with pytest.raises(ValueError, match="same bar column: \\['close'\\]"):
        norm.canonical_names(["t", "T", "c", "close"])
    missing = spark.createDataFrame([("A",)], "symbol string")
    with pytest.raises(ValueError, match="\\['close', 'high', 'low', 'n_trades', 'open'"):
        norm.validate_bars(missing)


def test_symbol_filter(spark):
    df = close_bars(spark, [("2024-01-02", "A", 1.0), ("2024-01-02", "B", 2.0)])
    assert norm.for_symbols(df, ["B"]).count() == 1
    assert norm.for_symbols(df, []).count() == norm.for_symbols(df, None).count() == 2


def test_reference_records(spark):
    raw = spark.createDataFrame(
        [("A", "Alpha", "XNYS", "CS", True)],
        "ticker string, name string, primary_exchange string, type string, active boolean",
    )
    out = norm.securities(raw)
    assert table(out, "symbol", "exchange", "sector", "industry", "is_active") == [
        ("A", "XNYS", None, None, True)
    ]
    with pytest.raises(ValueError, match="\\['name'\\]"):
        norm.securities(raw.drop("name"))


def test_event_range(spark):
    raw = spark.createDataFrame(
        [("A", "2024-01-02", 1.0), ("A", "2024-01-05", 1.0), ("A", "soon", 1.0)],
        "ticker string, ex_dividend_date string, cash_amount double",
    )
    assert norm.dividend_events(raw).count() == 3
    assert norm.dividend_events(raw, start=date(2024, 1, 2)).count() == 2
    assert norm.dividend_events(raw, end=date(2024, 1, 2)).count() == 1


def test_first_row_of_a_key_stays(spark):
    df = close_bars(
        spark,
        [("2024-01-02", "A", 1.0), ("2024-01-02", "A", 2.0), ("2024-01-02", None, 3.0),
         ("2024-01-02", None, 4.0), ("2024-01-03", "A", 5.0)],
    ).coalesce(1)
    out = merge.drop_duplicates_keep_first(df, merge.BAR_KEY)
    assert out.columns == df.columns
    assert sorted(r.close for r in out.collect()) == [1.0, 3.0, 5.0]


def test_hot_key_collapses_before_the_shuffle(spark):
    """Copies of one key reach the reducers once per task, not once per row."""
    df = spark.range(200_000, numPartitions=4).select(
        F.lit("A").alias("symbol"), F.lit("2024-01-02").alias("execution_date"), F.col("id").alias("v")
    )
    out = merge.drop_duplicates_keep_first(df, ["symbol", "execution_date"], "v")
    assert out.collect()[0].v == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_merge_keeps_existing_rows(spark):
    old = close_bars(spark, [("2024-01-02", "A", 1.0), ("2024-01-02", None, 9.0)])
    new = close_bars(
        spark, [("2024-01-02", "A", 7.0), ("2024-01-03", "A", 2.0), ("2024-01-03", "A", 3.0),
                ("2024-01-02", None, 8.0)]
    ).coalesce(1).withColumn("extra", F.lit("x"))
    once = merge.merge_keep_existing(old, new)
    got = table(once, "timestamp", "symbol", "close", "extra")
    want = sorted(
        [("2024-01-02 00:00", "A", 1.0, None), ("2024-01-02 00:00", None, 9.0, None),
         ("2024-01-03 00:00", "A", 2.0, "x")], key=repr
    )
    assert got == want
    twice = merge.merge_keep_existing(once, new)
    assert table(twice, "timestamp", "symbol", "close", "extra") == want


def test_key_choice(spark):
    df = bars(spark, [])
    assert merge.dedupe_columns(df, ["symbol", "execution_date"]) == ["symbol"]
    assert merge.dedupe_columns(df.drop("symbol"), ["symbol"]) == df.drop("symbol").columns
    dated = df.withColumn("date", F.lit("x"))
    assert merge.dedupe_columns(dated, ["nothing"]) == ["symbol", "date"]
