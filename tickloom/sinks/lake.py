"""Writers of the bar lake.

A merge keeps existing rows, inserts new keys and updates nothing. That makes it an append of
the rows whose key is not there yet: no file is rewritten, a run that died half-way is
completed by running it again, and running twice changes nothing.

Dimensions and events can be updated too (``mode="upsert"``): the table then becomes a history
of versions, dealt by key, of which only the partitions that a batch changes are rewritten.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import UTC, date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.scalars import freq_checked, in_range
from tickloom.operators import actions, ledger, versions
from tickloom.operators.merge import (
    BAR_KEY,
    dedupe_columns,
    drop_duplicates_keep_first,
    new_rows,
)
from tickloom.operators.normalize import validate_bars
from tickloom.session import children, move, remove, scratch_run, stage
from tickloom.sources import parts
from tickloom.sources.lake import (
    BY_SYMBOL,
    PARTITION,
    Lake,
    bars_schema,
    bucket_table,
    has_history,
    history_name,
    load_dividends,
    load_history,
    load_ledger,
    load_splits,
    scan_bars,
    scan_bars_by_symbol,
    symbol_layout,
)

#: Symbols that a row group's Bloom filter is sized for: a day of a whole market.
MARKET = 20_000

#: Up to so many symbols are named to a reader; more are met in a join, with the same rows.
NAMED = 1000


def _append(df: DataFrame, path: str, partition: str | None, order: Sequence[str]) -> None:
    """Append files sorted for row-group pruning. The rebalance hint lets Spark split a
    partition that holds much of the data and pack small ones.

    Bars are looked up by symbol in files that hold part of the alphabet or all of it: beside
    the least and largest symbol, each row group keeps a Bloom filter of its symbols.
    """
    if partition:
        df = df.hint("rebalance", partition).sortWithinPartitions(partition, *order)
        writer = df.write.mode("append").partitionBy(partition)
        writer = writer.option("parquet.bloom.filter.enabled#symbol", "true")
        writer.option("parquet.bloom.filter.expected.ndv#symbol", str(MARKET)).parquet(path)
    else:
        df.hint("rebalance").sortWithinPartitions(*order).write.mode("append").parquet(path)


def unique_bars(df: DataFrame) -> DataFrame:
    """Validated bars in UTC, first row of each (timestamp, symbol) in input order.

    Bars without a timestamp have no partition and are left out.
    """
    stamped = validate_bars(df).where(F.col("timestamp").isNotNull())
    return drop_duplicates_keep_first(stamped, BAR_KEY)


def with_partition(df: DataFrame, freq: str) -> DataFrame:
    """Add the partition column: the bar's UTC year or UTC date."""
    stamp = F.col("timestamp")
    part = F.year(stamp) if freq == "1d" else F.to_date(stamp)
    return df.withColumn(PARTITION[freq], part)


def write_bars(lake: Lake, df: DataFrame, freq: str) -> list[str]:
    """Merge bars into the lake; returns the touched partitions.

    The incoming rows are staged once, so that raw files are parsed once and the set of
    touched partitions (one value per day or year) is read from the staged table.
    """
    with scratch_run(lake.spark, lake.path("staging")):
        staged = stage(with_partition(unique_bars(df), freq_checked(freq)), f"bars-{freq}")
        return write_staged_bars(lake, staged, freq)


def write_staged_bars(lake: Lake, staged: DataFrame, freq: str) -> list[str]:
    """Merge bars that are unique and carry their partition column."""
    part = PARTITION[freq]
    touched = sorted(r[0] for r in staged.select(part).distinct().collect())
    if not touched:
        return []
    existing = lake.table(f"bars_{freq}", bars_schema(freq)).where(F.col(part).isin(touched))
    fresh = new_rows(existing, staged, [part, *BAR_KEY])
    if freq == "1d":
        _append_by_symbol(lake, staged)
    _append(fresh, lake.bars_path(freq), part, ["symbol", "timestamp"])
    return [f"{part}={value}" for value in touched]


def lay_out_by_symbol(lake: Lake, buckets: int = 64) -> str:
    """Write the stored daily bars a second time, in buckets by symbol; returns the folder.

    Later merges keep the layout up to date. It serves long ranges of symbols: a daily panel
    then needs no exchange of the bars, and a few symbols are read from their buckets alone.
    Minute panels are dealt by symbol and date, which buckets by symbol would not serve. A
    layout of another number of buckets takes the place of the old one when it is complete.
    """
    spark, old = lake.spark, symbol_layout(lake)
    path = lake.path(BY_SYMBOL, f"buckets-{buckets}-{time.time_ns()}")
    bars = scan_bars(lake, "1d").select(*schemas.BARS.names)
    _insert_by_symbol(bars, bucket_table(spark, path, buckets), buckets)
    if old is not None:
        spark.sql(f"DROP TABLE {bucket_table(spark, *old)}")
        remove(spark, old[0])
    return path


def _insert_by_symbol(bars: DataFrame, table: str, buckets: int) -> None:
    """One file a bucket: the exchange is the one that the buckets stand for."""
    dealt = bars.select(*schemas.BARS.names).repartition(buckets, "symbol")
    dealt.write.insertInto(table)
    bars.sparkSession.catalog.refreshTable(table)


def _append_by_symbol(lake: Lake, staged: DataFrame) -> None:
    """Bring the layout by symbol up to date, where there is one.

    What it lacks is told from the layout itself, not from the layout by date, so a run that
    died between the two is completed by running it again. Stored keys stay in their buckets;
    only the incoming ones are exchanged.
    """
    layout = symbol_layout(lake)
    if layout is None:
        return
    edge = staged.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).first()
    stored, buckets = scan_bars_by_symbol(lake)
    stored = stored.where(F.col("timestamp").between(F.lit(edge.lo), F.lit(edge.hi)))
    fresh = new_rows(stored, staged, list(BAR_KEY))
    fresh = stage(_typed(fresh, schemas.BARS), "by-symbol")
    _insert_by_symbol(fresh, bucket_table(lake.spark, *layout), buckets)


def _merge_table(
    lake: Lake, df: DataFrame, name: str, key: Sequence[str], schema, mode: str, at
) -> str:
    if mode not in ("keep", "upsert"):
        raise ValueError(f"mode is keep or upsert, not {mode!r}")
    if mode == "upsert" or has_history(lake, name):
        update_history(lake, df, name, key, at or datetime.now(UTC), mode == "upsert")
        return lake.path(history_name(name))
    unique = drop_duplicates_keep_first(df, key)
    fresh = new_rows(lake.table(name, schema), unique, key)
    _append(fresh, lake.path(name), None, list(key))
    return lake.path(name)


def update_history(
    lake: Lake, df: DataFrame, name: str, key: Sequence[str], at: datetime | date, update: bool = True
) -> list[int]:
    """Merge a batch into the history of a table; returns the partitions it changed.

    Partitions are dealt by key. Only those that keys of the batch fall into are read, and only
    those in which a row was added or changed are written again; a batch that brings nothing
    new writes nothing. A run that died is completed by running the batch again.
    """
    with scratch_run(lake.spark, lake.path("staging")):
        if not has_history(lake, name):
            flat = load_history(lake, name).withColumn(versions.PART, versions.part_of(key))
            _replace(lake, stage(flat, f"{name}-flat"), history_name(name), versions.PART)
        batch = drop_duplicates_keep_first(df, key).withColumn(versions.PART, versions.part_of(key))
        batch = stage(batch, f"{name}-batch")
        parts = [r[0] for r in batch.select(versions.PART).distinct().collect()]
        history = load_history(lake, name, parts)
        after = versions.next_versions(history, batch.drop(versions.PART), key, at, update)
        after = stage(after.withColumn(versions.PART, versions.part_of(key)), f"{name}-versions")
        changed = sorted(r[0] for r in after.where("touched").select(versions.PART).distinct().collect())
        if changed:
            rows = after.where(F.col(versions.PART).isin(changed)).drop("touched")
            writer = _by_part(rows, key).write.mode("overwrite")
            writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(versions.PART)
            writer.parquet(lake.path(history_name(name)))
            lake.spark.catalog.refreshByPath(lake.path(history_name(name)))
        return changed


def _by_part(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    order = [versions.PART, *key, versions.VALID_FROM]
    return rows.hint("rebalance", versions.PART).sortWithinPartitions(*order)


def _typed(df: DataFrame, schema) -> DataFrame:
    """Cast known columns to the table's types; others stay."""
    types = {f.name: f.dataType for f in schema.fields if f.name in df.columns}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def write_security_master(
    lake: Lake, df: DataFrame, mode: str = "keep", at: datetime | date | None = None
) -> str:
    """Merge securities by symbol.

    ``keep`` leaves what is stored; ``upsert`` opens a new version, valid from ``at`` (default:
    now), of every security whose values differ. A table that was once updated stays versioned.
    """
    schema = schemas.SECURITY_MASTER
    return _merge_table(lake, _typed(df, schema), "security_master", ["symbol"], schema, mode, at)


def write_splits(
    lake: Lake, df: DataFrame, mode: str = "keep", at: datetime | date | None = None
) -> str:
    """Merge split events by symbol and execution date; modes as for securities."""
    key = dedupe_columns(df, ["symbol", "execution_date"])
    return _merge_table(lake, _typed(df, schemas.SPLITS), "splits", key, schemas.SPLITS, mode, at)


def write_dividends(
    lake: Lake, df: DataFrame, mode: str = "keep", at: datetime | date | None = None
) -> str:
    """Merge dividend events by symbol and ex-dividend date; modes as for securities."""
    key, schema = dedupe_columns(df, ["symbol", "ex_dividend_date"]), schemas.DIVIDENDS
    return _merge_table(lake, _typed(df, schema), "dividends", key, schema, mode, at)


def write_universe(lake: Lake, snapshots: DataFrame) -> str:
    """Merge universe snapshots by symbol within each day; only touched days are read."""
    key = ["date", "symbol"]
    unique = drop_duplicates_keep_first(snapshots.select(*schemas.UNIVERSE.names), key)
    with scratch_run(lake.spark, lake.path("staging")):
        staged = stage(unique, "universe")
        days = [r.date for r in staged.select("date").distinct().collect()]
        existing = lake.table("universe", schemas.UNIVERSE).where(F.col("date").isin(days))
        _append(new_rows(existing, staged, key), lake.path("universe"), "date", ["symbol"])
    return lake.path("universe")


def replace_universe(lake: Lake, snapshots: DataFrame) -> str:
    """Put snapshots in the place of those of the same days; other days are not touched."""
    path = lake.path("universe")
    (
        snapshots.select(*schemas.UNIVERSE.names)
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "symbol")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )
    return path


def _replace(lake: Lake, table: DataFrame, name: str, partition: str | None = None) -> str:
    """Write a table beside the old one, then swap them: a run that fails leaves the old one."""
    path, new = lake.path(name), lake.path(f"{name}.new-{uuid.uuid4().hex}")
    old = new.replace(".new-", ".old-")
    (table.write.partitionBy(partition) if partition else table.write).parquet(new)
    had = move(lake.spark, path, old)
    move(lake.spark, new, path)
    lake.spark.catalog.refreshByPath(path)
    if had:
        remove(lake.spark, old)
    return path


def build_split_ratio_table(
    lake: Lake, start: date | None = None, end: date | None = None
) -> str:
    """Bring the split-ratio table up to date with the split events."""
    return refresh_actions(
        lake, "split_ratios", load_splits(lake), "execution_date", actions.build_split_ratios,
        schemas.SPLIT_RATIOS, has_history(lake, "splits"), start, end,
    )


def build_dividend_cash_table(
    lake: Lake, start: date | None = None, end: date | None = None
) -> str:
    """Bring the cash-dividend table up to date with the dividend events."""
    return refresh_actions(
        lake, "cash_dividends", load_dividends(lake), "ex_dividend_date",
        actions.build_cash_dividends, schemas.CASH_DIVIDENDS, has_history(lake, "dividends"),
        start, end,
    )


def refresh_actions(
    lake: Lake,
    name: str,
    events: DataFrame,
    day: str,
    build: Callable[..., DataFrame],
    schema: T.StructType,
    versioned: bool,
    start: date | None,
    end: date | None,
) -> str:
    """Rebuild the (date, symbol) keys of an action table that events new since its last build touch.

    New events are those in files that the last build had not seen, and those between its end
    and this one's. Of the stored events only their symbols are read, of the table only their
    partitions; other partitions stay where they are. The first build, an earlier end, another
    start, or event files that are gone without a history of versions rebuild the whole table.
    A build with nothing new writes nothing. Returns the folder of the builds.
    """
    spark, path = lake.spark, lake.path(parts.parts_name(name))
    files = {file.rsplit("/", 1)[-1]: file for file in events.inputFiles()}
    now = parts.State({}, frozenset(files), start, end)
    last = parts.latest_state(lake, name)
    if last is not None and (last.sources, last.start, last.end) == (now.sources, start, end):
        return path
    with scratch_run(spark, lake.path("staging")):
        if last is None or not _extends(last, now, versioned):
            rows = build(events, start, end)
            folders = _write_parts(lake, name, rows, schema)
        else:
            touched = _touched(lake, events, day, [files[f] for f in now.sources - last.sources], last, end)
            held = [r[0] for r in touched.select(versions.part_of(["symbol"])).distinct().collect()]
            rows = build(_of_keys(events, touched, day), start, end)
            stored = parts.read_parts(lake, name, schema, last, held)
            kept = stored.join(touched, ["symbol", "date"], "left_anti")
            other = {p: folder for p, folder in last.folders.items() if p not in held}
            rows = rows.select(*schema.names).unionByName(kept.select(*schema.names))
            folders = other | (_write_parts(lake, name, rows, schema) if held else {})
        parts.publish(lake, name, replace(now, folders=folders))
    return path


def _extends(last: parts.State, now: parts.State, versioned: bool) -> bool:
    """Whether a build can start from the last one. Files of a history may be gone: a
    partition of it is rewritten with every key that it held."""
    later = now.end is None or now.end >= last.end if last.end else now.end is None
    return last.start == now.start and later and (versioned or last.sources <= now.sources)


def _touched(
    lake: Lake, events: DataFrame, day: str, fresh: list[str], last: parts.State, end: date | None
) -> DataFrame:
    """Keys of the events in files not seen before and of those past the last build's end."""
    key = [F.col("symbol"), F.col(day).cast("date").alias("date")]
    keys = []
    if fresh:
        keys.append(lake.spark.read.schema(f"symbol string, {day} string").parquet(*fresh).select(*key))
    if last.end is not None and last.end != end:
        keys.append(events.select(*key).where(in_range(F.col("date"), last.end + timedelta(days=1), end)))
    if not keys:
        return lake.spark.createDataFrame([], "symbol string, date date")
    return stage(reduce(DataFrame.unionByName, keys).dropna().distinct(), "touched")


def _of_keys(events: DataFrame, touched: DataFrame, day: str) -> DataFrame:
    """Events of some keys. Few symbols are also named to the Parquet reader, which then skips
    row groups; events are stored sorted by symbol."""
    symbols = [r[0] for r in touched.select("symbol").distinct().limit(NAMED + 1).collect()]
    if len(symbols) <= NAMED:
        events = events.where(F.col("symbol").isin(symbols))
    dated = events.withColumn("date", F.col(day).cast("date"))
    return dated.join(touched, ["symbol", "date"], "left_semi").drop("date")


def _write_parts(lake: Lake, name: str, rows: DataFrame, schema: T.StructType) -> dict[int, str]:
    """Write rows below a new folder; the partitions it holds."""
    folder = parts.new_folder("rows")
    dealt = rows.select(*schema.names).withColumn(versions.PART, versions.part_of(["symbol"]))
    dealt = dealt.hint("rebalance", versions.PART).sortWithinPartitions(versions.PART, "symbol", "date")
    path = lake.path(parts.parts_name(name), folder)
    dealt.write.partitionBy(versions.PART).parquet(path)
    found = [c.removeprefix("part=") for c in children(lake.spark, path) if c.startswith("part=")]
    return {int(p): folder for p in found}


def build_corporate_actions_tables(
    lake: Lake, start: date | None = None, end: date | None = None
) -> tuple[str, str]:
    """Bring both action tables up to date; without bounds all events are used."""
    return (
        build_split_ratio_table(lake, start, end),
        build_dividend_cash_table(lake, start, end),
    )


def record_days(lake: Lake, freq: str, events: dict[str, DataFrame]) -> None:
    """Append ledger events of one frequency as one batch: status to its days."""
    base = ledger.next_seq(load_ledger(lake))
    days = [df.select("date", F.lit(status).alias("status")) for status, df in events.items()]
    batch = reduce(DataFrame.unionByName, days)
    rows = ledger.ledger_rows(batch, freq_checked(freq), base)
    rows.coalesce(1).write.mode("append").parquet(lake.path("ledger"))


def record(lake: Lake, day: date, freq: str, status: str) -> None:
    """Append one ledger event."""
    record_days(lake, freq, {status: lake.spark.createDataFrame([(day,)], "date date")})


__all__ = [
    "build_corporate_actions_tables",
    "build_dividend_cash_table",
    "build_split_ratio_table",
    "lay_out_by_symbol",
    "record",
    "record_days",
    "refresh_actions",
    "replace_universe",
    "unique_bars",
    "update_history",
    "with_partition",
    "write_bars",
    "write_dividends",
    "write_security_master",
    "write_splits",
    "write_staged_bars",
    "write_universe",
]
