"""The bar lake: paths and scans.

Layout below the root::

    bars_1d/year=YYYY/        bars_1min/date=YYYY-MM-DD/    (UTC dates)
    splits/ dividends/
    universe/date=YYYY-MM-DD/  security_master/  ledger/
    bars_1d_by_symbol/buckets-N-.../    daily bars a second time, bucketed by symbol
    <table>_history/part=N/    every version of a table that is updated in place
    <table>_parts/             builds of an action table (see ``sources.parts``)
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.scalars import freq_checked, instant, utc_date
from tickloom.operators import actions, versions
from tickloom.session import children, exists
from tickloom.sources import parts

# Partition column of each bar table.
PARTITION = {"1d": "year", "1min": "date"}
PARTITION_TYPE = {"1d": T.IntegerType(), "1min": T.DateType()}


@dataclass(frozen=True)
class Lake:
    """A session and the folder that holds the tables."""

    spark: SparkSession
    root: str

    def path(self, *parts: str) -> str:
        return "/".join([str(self.root).rstrip("/"), *parts])

    def bars_path(self, freq: str) -> str:
        return self.path(f"bars_{freq_checked(freq)}")

    def table(self, name: str, schema: T.StructType, extras: bool = False) -> DataFrame:
        """A table, or an empty frame of its schema where it does not exist yet.

        ``extras`` also reads columns beyond the schema.
        """
        reader = self.spark.read
        reader = reader.option("mergeSchema", "true") if extras else reader.schema(schema)
        try:
            table = reader.parquet(self.path(name))
            lost = [c for c in schema.names if c not in table.columns]
            return table if not lost else self.spark.read.schema(
                T.StructType([*schema.fields, *[f for f in table.schema if f.name not in schema.names]])
            ).parquet(self.path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], schema)


def bars_schema(freq: str) -> T.StructType:
    """Bar columns plus the partition column."""
    part = T.StructField(PARTITION[freq], PARTITION_TYPE[freq])
    return T.StructType([*schemas.BARS.fields, part])


def scan_bars(
    lake: Lake,
    freq: str,
    start: datetime | None = None,
    end: datetime | None = None,
    extras: bool = False,
) -> DataFrame:
    """Bars of one frequency. The time range is also stated on the partition column,
    which Spark does not derive from a timestamp predicate by itself."""
    bars = lake.table(f"bars_{freq_checked(freq)}", bars_schema(freq), extras)
    part = PARTITION[freq]
    for bound, side in ((start, "ge"), (end, "le")):
        if bound is None:
            continue
        day = utc_date(bound)
        edge = F.lit(day.year if freq == "1d" else day)
        at = instant(bound)
        if side == "ge":
            bars = bars.where((F.col(part) >= edge) & (F.col("timestamp") >= at))
        else:
            bars = bars.where((F.col(part) <= edge) & (F.col("timestamp") <= at))
    return bars.drop(part)


BY_SYMBOL = "bars_1d_by_symbol"


def symbol_layout(lake: Lake) -> tuple[str, int] | None:
    """Folder and number of buckets of the daily bars by symbol; None where they are not laid out.

    The newest finished folder counts: one that is being written has no mark of success yet.
    """
    done = [
        name for name in children(lake.spark, lake.path(BY_SYMBOL))
        if name.startswith("buckets-") and exists(lake.spark, lake.path(BY_SYMBOL, name, "_SUCCESS"))
    ]
    if not done:
        return None
    newest = max(done, key=lambda name: int(name.split("-")[2]))
    return lake.path(BY_SYMBOL, newest), int(newest.split("-")[1])


def bucket_table(spark: SparkSession, path: str, buckets: int) -> str:
    """The catalog's name of a folder of bars that is bucketed by symbol. Spark knows buckets only
    of tables in a catalog, and the catalog of a session may not know the folder yet."""
    name = f"tickloom_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.BARS)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY (symbol) "
        f"SORTED BY (symbol, timestamp) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return name


def scan_bars_by_symbol(
    lake: Lake, start: datetime | None = None, end: datetime | None = None
) -> tuple[DataFrame, int]:
    """Daily bars as they lie in the layout by symbol, and how many buckets that has.

    A filter on symbols reads their buckets alone, and what is grouped by symbol needs no
    exchange of the bars.
    """
    layout = symbol_layout(lake)
    if layout is None:
        raise FileNotFoundError(f"{lake.path(BY_SYMBOL)}: lay the daily bars out by symbol first")
    bars = lake.spark.table(bucket_table(lake.spark, *layout))
    if start is not None:
        bars = bars.where(F.col("timestamp") >= instant(start))
    if end is not None:
        bars = bars.where(F.col("timestamp") <= instant(end))
    return bars, layout[1]


def trading_day_bars(lake: Lake, freq: str, days: list[date]) -> DataFrame:
    """Stored bars of some trading days, with their day in ``trading_day``.

    A bar keeps the day of its source file; a bar that came without one counts for its UTC
    date. Trading after hours can reach into the next UTC date, so a day's neighbours are
    read as well.
    """
    day = T.StructField("trading_day", T.DateType())
    bars = lake.table(f"bars_{freq}", T.StructType([*bars_schema(freq).fields, day]))
    near = {d + timedelta(days=k) for d in days for k in (-1, 0, 1)}
    parts = sorted({d.year for d in near} if freq == "1d" else near)
    bars = bars.where(F.col(PARTITION[freq]).isin(parts))
    bars = bars.withColumn("trading_day", F.coalesce("trading_day", F.to_date("timestamp")))
    return bars.where(F.col("trading_day").isin(days)).drop(PARTITION[freq])


def scan_foreign_bars(spark: SparkSession, root: str, freq: str) -> DataFrame:
    """Bars of a lake laid out as ``bars/freq=<freq>/**/*.parquet`` by another tool.

    Such files often hold nanosecond stamps, which Spark only reads as integers. That is a
    setting of a session, so the frame belongs to one of its own; the caller's stays as it is.
    Write it to a lake, or put it on the left of a join.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark = spark.newSession()
    spark.conf.set("spark.sql.session.timeZone", zone)
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    bars = (
        spark.read.option("recursiveFileLookup", "true")
        .option("mergeSchema", "true")
        .parquet(f"{root.rstrip('/')}/bars/freq={freq_checked(freq)}")
    )
    if isinstance(bars.schema["timestamp"].dataType, T.LongType):
        return bars.withColumn("timestamp", F.timestamp_micros(F.expr("timestamp div 1000")))
    return bars.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


#: Tables that can be updated: their schema.
VERSIONED = {
    "security_master": schemas.SECURITY_MASTER,
    "splits": schemas.SPLITS,
    "dividends": schemas.DIVIDENDS,
}


def history_name(name: str) -> str:
    return f"{name}_history"


def has_history(lake: Lake, name: str) -> bool:
    """Whether a table was ever updated. From then on its history holds it."""
    return exists(lake.spark, lake.path(history_name(name)))


def load_history(lake: Lake, name: str, parts: list[int] | None = None) -> DataFrame:
    """Every version of a table's rows with ``valid_from`` and ``valid_to``.

    A table that was never updated has one version of each row, valid since ever. ``parts``
    limits the history to partitions of its keys.
    """
    schema = VERSIONED[name]
    if not has_history(lake, name):
        table = lake.table(name, schema, extras=True)
        always = {f.name: F.lit(None).cast(f.dataType) for f in versions.PERIOD_FIELDS}
        return table.withColumns(always)
    part = T.StructField(versions.PART, T.IntegerType())
    stored = T.StructType([*schema.fields, *versions.PERIOD_FIELDS, part])
    history = lake.table(history_name(name), stored, extras=True)
    if parts is not None:
        history = history.where(F.col(versions.PART).isin(parts))
    return history.drop(versions.PART)


def _load(lake: Lake, name: str, as_of: datetime | date | None) -> DataFrame:
    if has_history(lake, name):
        return versions.as_of(load_history(lake, name), as_of)
    return lake.table(name, VERSIONED[name], extras=True)


def load_security_master(lake: Lake, as_of: datetime | date | None = None) -> DataFrame:
    """Security master with all columns stored; seven empty ones where it does not exist.

    ``as_of`` gives the rows as they were known then (a plain date: at its beginning).
    """
    return _load(lake, "security_master", as_of)


def load_splits(lake: Lake, as_of: datetime | date | None = None) -> DataFrame:
    """Split events with all columns stored, as known now or at ``as_of``."""
    return _load(lake, "splits", as_of)


def load_dividends(lake: Lake, as_of: datetime | date | None = None) -> DataFrame:
    """Dividend events with all columns stored, as known now or at ``as_of``."""
    return _load(lake, "dividends", as_of)


def _load_built(lake: Lake, name: str, schema: T.StructType) -> DataFrame:
    """The newest build of an action table; a plain table where it was built before there were any."""
    state = parts.latest_state(lake, name)
    return lake.table(name, schema) if state is None else parts.read_parts(lake, name, schema, state)


def load_split_ratio_table(
    lake: Lake,
    start: date | None = None,
    end: date | None = None,
    symbols: list[str] | None = None,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Split ratios ``(date, symbol, split_ratio)`` with optional filters.

    With ``as_of`` they are built from the events known then, not read from the stored table.
    """
    if as_of is None:
        table = _load_built(lake, "split_ratios", schemas.SPLIT_RATIOS)
    else:
        table = actions.build_split_ratios(load_splits(lake, as_of), start, end)
    return actions.filter_actions(table, start, end, symbols)


def load_dividend_cash_table(
    lake: Lake,
    start: date | None = None,
    end: date | None = None,
    symbols: list[str] | None = None,
    as_of: datetime | date | None = None,
) -> DataFrame:
    """Cash dividends ``(date, symbol, cash_amount)`` with optional filters.

    With ``as_of`` they are built from the events known then, not read from the stored table.
    """
    if as_of is None:
        table = _load_built(lake, "cash_dividends", schemas.CASH_DIVIDENDS)
    else:
        table = actions.build_cash_dividends(load_dividends(lake, as_of), start, end)
    return actions.filter_actions(table, start, end, symbols)


def load_universe_snapshot(lake: Lake, day: date) -> DataFrame:
    """Universe of one day (one partition is read); empty where there is none."""
    universe = lake.table("universe", schemas.UNIVERSE)
    return universe.select(*schemas.UNIVERSE.names).where(F.col("date") == F.lit(day))


def load_universe(lake: Lake) -> DataFrame:
    """Universe of all days."""
    return lake.table("universe", schemas.UNIVERSE).select(*schemas.UNIVERSE.names)


def load_ledger(lake: Lake) -> DataFrame:
    """Ingestion ledger in no particular order; ``seq`` tells it."""
    return lake.table("ledger", schemas.LEDGER)
