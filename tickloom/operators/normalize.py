"""Raw vendor rows to bars, and raw reference records to dimension and event tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import in_range, number, require_utc
from tickloom.schemas import BARS, DIVIDENDS, OPTIONAL, SECURITY_MASTER, SPLITS, VALUE_FIELDS

# Vendor column names (case-sensitive) and the bar column each one feeds.
ALIASES = {
    "t": "timestamp",
    "timestamp": "timestamp",
    "window_start": "timestamp",
    "ticker": "symbol",
    "T": "symbol",
    "symbol": "symbol",
    "o": "open",
    "open": "open",
    "h": "high",
    "high": "high",
    "l": "low",
    "low": "low",
    "c": "close",
    "close": "close",
    "vw": "vwap",
    "vwap": "vwap",
    "v": "volume",
    "volume": "volume",
    "n": "n_trades",
    "n_trades": "n_trades",
    "transactions": "n_trades",
}

# Names of vendor reference records and of our columns.
REFERENCE_NAMES = {"ticker": "symbol", "primary_exchange": "exchange", "active": "is_active"}

#: Epoch stamps above these are of that unit, else seconds; the largest stamp of a file decides.
#: They tell all four units apart for times since 1973.
UNITS = {"nanos": 10**17, "micros": 10**14, "millis": 10**11}

# Thresholds without microseconds, which take them for nanoseconds.
ORIGINAL_UNITS = {"nanos": 10**15, "millis": 10**12}

def canonical_names(columns: Sequence[str]) -> list[str]:
    """Bar column name for each raw column, by position; unknown names stay."""
    names = [ALIASES.get(c, c) for c in columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"Several raw columns feed the same bar column: {twice}")
    for needed in ("timestamp", "symbol"):
        if needed not in names:
            raise ValueError(f"no raw column feeds {needed}: {list(columns)}")
    return names


def rename_bars(raw: DataFrame) -> DataFrame:
    """Positional rename, which also works where ``t`` and ``T`` both occur."""
    return raw.toDF(*canonical_names(raw.columns))


def _is_numeric(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _floor_div(value: Column, by: int) -> Column:
    """Integer division rounding down (a double quotient would lose nanosecond digits)."""
    return ((value - F.pmod(value, F.lit(by))) / F.lit(by)).cast("bigint")


def epoch_timestamp(value: Column, largest: Column, original_units: bool = False) -> Column:
    """Epoch number to timestamp; the unit follows from the largest value.

    ``original_units`` uses the thresholds without microseconds.
    """
    whole = value.cast("bigint")
    read = {
        "nanos": F.timestamp_micros(_floor_div(whole, 1000)),
        "micros": F.timestamp_micros(whole),
        "millis": F.timestamp_millis(whole),
    }
    out = F.timestamp_seconds(whole)
    for unit, above in reversed((ORIGINAL_UNITS if original_units else UNITS).items()):
        out = F.when(largest > above, read[unit]).otherwise(out)
    return out


def normalize_timestamp(
    df: DataFrame, per: str | None = None, original_units: bool = False
) -> DataFrame:
    """``timestamp`` as a UTC instant, from epoch numbers or text.

    Whether stamps are numbers, and their unit, is decided per source file (``per`` names
    the column telling files apart) or over the whole frame. One partial aggregate finds
    it; the result, one row per file, joins back by broadcast when the number of files,
    known from the listing, is below a bound.
    """
    require_utc(df.sparkSession)
    kind = df.schema["timestamp"].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    stamp = F.col("timestamp")
    if _is_numeric(kind):
        as_number, is_text = stamp.cast("bigint"), F.lit(False)
    else:
        as_number = F.coalesce(
            stamp.try_cast("bigint"), F.floor(stamp.try_cast("double")).cast("bigint")
        )
        is_text = stamp.isNotNull() & as_number.isNull()
    facts = [F.max(as_number).alias("_largest"), F.max(is_text).alias("_has_text")]
    if per is None:
        one = df.agg(F.struct(*facts).alias("f")).scalar()
        df = df.withColumn("_unit", one)
        largest, has_text = F.col("_unit._largest"), F.col("_unit._has_text")
    else:
        df = df.join(df.groupBy(per).agg(*facts), per, "left")
        largest, has_text = F.col("_largest"), F.col("_has_text")
    parsed = epoch_timestamp(as_number, largest, original_units)
    if not _is_numeric(kind):
        parsed = F.when(has_text, stamp.cast("timestamp")).otherwise(parsed)
    return df.withColumn("timestamp", parsed).drop("_unit", "_largest", "_has_text")


def _default(name: str) -> Column:
    """What stands for a bar column that a source does not have."""
    return F.col("close") if name == "vwap" else F.lit(0)


def fill_absent_columns(df: DataFrame) -> DataFrame:
    """Defaults for columns the source does not have at all (nulls stay)."""
    absent = [c for c in BARS.names if c in OPTIONAL and c not in df.columns]
    if "close" not in df.columns:
        absent = [c for c in absent if c != "vwap"]
    return df.withColumns({c: _default(c) for c in absent})


def whole_number(name: str) -> Column:
    """A count: text may write it as ``12`` or ``12.0``; what is no whole number becomes null."""
    value = number(name)
    whole = F.when(value == F.floor(value), value.try_cast("bigint"))
    return F.coalesce(F.col(name).cast("string").try_cast("bigint"), whole)


def type_bars(df: DataFrame) -> DataFrame:
    """Cast columns to the lake's types; a cell that is no number of its kind becomes null."""
    out = {}
    for field in BARS.fields:
        if field.name not in df.columns or field.name == "timestamp":
            continue
        if isinstance(field.dataType, T.DoubleType):
            out[field.name] = number(field.name)
        elif isinstance(field.dataType, T.LongType):
            out[field.name] = whole_number(field.name)
        else:
            out[field.name] = F.col(field.name).cast(field.dataType)
    return df.withColumns(out)


def bad_cells(raw: DataFrame, per: str) -> DataFrame:
    """Rows, rows without a usable timestamp, and unusable number cells of each source file."""
    named = rename_bars(raw)
    numbers = [c for c in VALUE_FIELDS if c in named.columns]
    typed = type_bars(normalize_timestamp(named.withColumns({f"_{c}": F.col(c) for c in numbers}), per))
    lost = [(F.col(f"_{c}").isNotNull() & F.col(c).isNull()).cast("bigint") for c in numbers]
    return typed.groupBy(per).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("timestamp").isNull()).alias("without_timestamp"),
        F.sum(sum(lost, F.lit(0).cast("bigint"))).alias("bad_numbers"),
    )


def normalize_bars(
    raw: DataFrame, per: str | None = None, original_units: bool = False
) -> DataFrame:
    """Vendor rows to bars: names, instants, types, defaults. Unknown columns are kept.

    ``original_units`` reads epoch stamps without microseconds, as older lakes did.
    """
    bars = normalize_timestamp(rename_bars(raw), per, original_units)
    return fill_absent_columns(type_bars(bars))


def for_symbols(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    """Keep the rows of some symbols; no list, or an empty one, keeps all."""
    return df.where(F.col("symbol").isin(list(symbols))) if symbols else df


def validate_bars(df: DataFrame) -> DataFrame:
    """Fail on missing bar columns, otherwise return bars in lake types, UTC."""
    missing = set(BARS.names) - set(df.columns)
    if missing:
        raise ValueError(f"not a bar table, it lacks {sorted(missing)}")
    require_utc(df.sparkSession)
    return type_bars(df.withColumn("timestamp", F.col("timestamp").cast("timestamp")))


def rename_reference(df: DataFrame) -> DataFrame:
    """Vendor names of reference records to ours."""
    return df.withColumnsRenamed(REFERENCE_NAMES)


def as_table(records: DataFrame, schema: T.StructType) -> DataFrame:
    """Records with the columns of a table: those it marks optional are added as null text,
    any other that is absent is an error. Further columns stay."""
    absent = [c for c in schema.names if c not in records.columns]
    lacking = [c for c in absent if c not in OPTIONAL]
    if lacking:
        raise ValueError(f"the reference records lack {lacking}")
    return records.withColumns({name: F.lit(None).cast("string") for name in absent})


def within_days(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """Rows whose date, held as text, lies in an inclusive range. A bound drops what is no date."""
    if start is None and end is None:
        return df
    return df.where(in_range(F.col(column).try_cast("date"), start, end))


def securities(records: DataFrame) -> DataFrame:
    """Security records to the seven columns of the security master, plus any extras."""
    df = as_table(rename_reference(records), SECURITY_MASTER)
    return df.withColumn("is_active", F.col("is_active").cast("boolean"))


def split_events(
    records: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Split records, optionally within a range of execution dates."""
    return within_days(as_table(rename_reference(records), SPLITS), "execution_date", start, end)


def dividend_events(
    records: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Dividend records, optionally within a range of ex-dividend dates."""
    return within_days(
        as_table(rename_reference(records), DIVIDENDS), "ex_dividend_date", start, end
    )
