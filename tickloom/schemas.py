"""Table schemas of the bar lake."""

from __future__ import annotations

from pyspark.sql import types as T

FREQS = ("1d", "1min")

# Field names of a bar and how a gap in each is filled.
PRICE_FIELDS = ("open", "high", "low", "close", "vwap")
COUNT_FIELDS = ("volume", "n_trades")
VALUE_FIELDS = PRICE_FIELDS + COUNT_FIELDS

# Columns that raw bars or reference records may lack.
OPTIONAL = frozenset({"vwap", "volume", "n_trades", "sector", "industry"})

# Volume is DOUBLE in the lake: vendors deliver whole and fractional volumes, and a
# partitioned table needs one type for all its files. Whole numbers stay exact to 2^53.
BARS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        *[T.StructField(f, T.DoubleType()) for f in PRICE_FIELDS],
        T.StructField("volume", T.DoubleType()),
        T.StructField("n_trades", T.LongType()),
    ]
)

SPLITS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("execution_date", T.StringType()),
        T.StructField("split_from", T.DoubleType()),
        T.StructField("split_to", T.DoubleType()),
    ]
)

DIVIDENDS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ex_dividend_date", T.StringType()),
        T.StructField("cash_amount", T.DoubleType()),
    ]
)

SPLIT_RATIOS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("split_ratio", T.DoubleType()),
    ]
)

CASH_DIVIDENDS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("cash_amount", T.DoubleType()),
    ]
)

UNIVERSE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("notional", T.DoubleType()),
        T.StructField("rank", T.LongType()),
    ]
)

SECURITY_MASTER = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("is_active", T.BooleanType()),
    ]
)

LEDGER = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("freq", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)
