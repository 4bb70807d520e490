"""Small literal frames for the tests."""

from datetime import UTC, datetime

from pyspark.sql import functions as F

BAR_FIELDS = ["open", "high", "low", "close", "vwap", "volume", "n_trades"]


def ts(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def bars(spark, rows):
    """Rows of (timestamp text, symbol, open, high, low, close, vwap, volume, n_trades)."""
    schema = (
        "timestamp string, symbol string, open double, high double, low double, "
        "close double, vwap double, volume bigint, n_trades bigint"
    )
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def close_bars(spark, rows):
    """Rows of (timestamp text, symbol, close[, volume]); other prices equal the close."""
    full = []
    for stamp, symbol, close, *rest in rows:
        volume = rest[0] if rest else 100
        full.append((stamp, symbol, close, close, close, close, close, volume, 1))
    return bars(spark, full)


def panel(spark, rows, field="close"):
    df = spark.createDataFrame(rows, f"timestamp string, symbol string, {field} double")
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def table(df, *cols, order=None):
    """Rows as tuples with timestamps and dates as text, sorted."""
    shown = [
        F.date_format(c, "yyyy-MM-dd HH:mm").alias(c)
        if df.schema[c].dataType.typeName() == "timestamp"
        else F.col(c).cast("string").alias(c)
        if df.schema[c].dataType.typeName() == "date"
        else F.col(c)
        for c in cols
    ]
    return sorted((tuple(r) for r in df.select(*shown).collect()), key=repr)
