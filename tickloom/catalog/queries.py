"""One query per operator, over whole test tables (see ``fixtures`` for their shapes)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.catalog import fixtures as fx
from tickloom.functions import calendar as cal
from tickloom.operators import actions, ledger, merge, normalize, panel, sessions, universe, versions
from tickloom.plans import jobs, prices
from tickloom.session import scratch_path
from tickloom.sinks import lake as sink
from tickloom.sources import lake as src
from tickloom.sources import raw
from tickloom.sources.day_files import read_day_files, stream_day_files
from tickloom.sources.lake import Lake
from tickloom.sources.reference import read_records
from tickloom.streaming.ingest import stream_bars
from tickloom.streaming.universe import stream_daily_universe

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given daily bars lie within these bounds at every scale, the minute bars in January 2024.
DAILY_SPAN = (datetime(1993, 1, 1), datetime(2030, 1, 1))
MINUTE_SPAN = (datetime(2024, 1, 1), datetime(2024, 1, 31, 23, 59))
MINUTE_DATES = (date(2024, 1, 1), date(2024, 1, 31))
VENDOR = "vendor"
BROKEN_DAY = date(2024, 1, 10)
SNAPSHOT_DAY = date(2024, 1, 18)


def query(fn: Query) -> Query:
    """Register a query under its function name; timestamps leave without a zone, as the
    test tables have them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return without_zone(fn(spark, sf_dir))

    QUERIES[fn.__name__] = run
    return run


def without_zone(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


def _daily(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    return fx.bars_1d(spark, sf_dir), ("1d", fx.DAILY_SYMBOLS, *DAILY_SPAN)


def _minutes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    return fx.bars_1min(spark, sf_dir), ("1min", fx.MINUTE_SYMBOLS, *MINUTE_SPAN)


def _ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.build_split_ratios(fx.splits(spark, sf_dir))


def _cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.build_cash_dividends(fx.dividends(spark, sf_dir))


# ---------------------------------------------------------------- panels


@query
def adjusted_close_panel(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    return panel.adjusted_price_panel(bars, _ratios(spark, sf_dir), _cash(spark, sf_dir), *args)


@query
def adjusted_volume_panel(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    return panel.adjusted_volume_panel(bars, _ratios(spark, sf_dir), *args)


@query
def panel_long_1d(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    return panel.price_panel(bars, *args, fields=["open", "close", "vwap", "volume"])


@query
def panel_long_1d_unfilled(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    return panel.price_panel(bars, *args, fill_missing_bars=False)


@query
def panel_long_1min(spark, sf_dir):
    bars, args = _minutes(spark, sf_dir)
    return panel.price_panel(bars, *args)


@query
def panel_long_1min_fields(spark, sf_dir):
    bars, args = _minutes(spark, sf_dir)
    return panel.price_panel(
        bars, *args, fields=["open", "high", "low", "close", "volume", "n_trades"]
    )


@query
def panel_long_1min_unfilled(spark, sf_dir):
    bars, args = _minutes(spark, sf_dir)
    return panel.price_panel(bars, *args, fields=["volume"], fill_missing_bars=False)


@query
def adjusted_close_panel_1min(spark, sf_dir):
    bars, args = _minutes(spark, sf_dir)
    return panel.adjusted_price_panel(
        bars,
        actions.build_split_ratios(fx.minute_splits(spark, sf_dir)),
        actions.build_cash_dividends(fx.minute_dividends(spark, sf_dir)),
        *args,
    )


@query
def adjusted_volume_panel_1min(spark, sf_dir):
    bars, args = _minutes(spark, sf_dir)
    ratios = actions.build_split_ratios(fx.minute_splits(spark, sf_dir))
    return panel.adjusted_volume_panel(bars, ratios, *args)


@query
def panel_wide_close(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    return panel.to_wide(panel.price_panel(bars, *args), symbols=fx.DAILY_SYMBOLS)


@query
def panel_wide_multi(spark, sf_dir):
    bars, args = _daily(spark, sf_dir)
    long = panel.price_panel(bars, *args, fields=["volume", "close"])
    return panel.to_wide(long, symbols=fx.DAILY_SYMBOLS)


@query
def panel_matrix_close(spark, sf_dir):
    """Closes as one array per timestamp, read back by slot of the symbol dictionary."""
    bars, args = _daily(spark, sf_dir)
    slots = panel.symbol_dictionary(bars)
    return panel.from_matrix(panel.to_matrix(panel.price_panel(bars, *args), slots), slots)


# ---------------------------------------------------------------- corporate actions


@query
def split_ratio_table(spark, sf_dir):
    return actions.build_split_ratios(fx.dirty_splits(spark, sf_dir))


@query
def cash_dividend_table(spark, sf_dir):
    return _cash(spark, sf_dir)


@query
def action_table_filter(spark, sf_dir):
    return actions.filter_actions(
        _cash(spark, sf_dir), date(1996, 3, 1), date(2000, 2, 29), ["S7", "S1", "nobody"]
    )


@query
def split_factors(spark, sf_dir):
    return actions.compute_split_factors(_raw_panel(spark, sf_dir), _ratios(spark, sf_dir))


def _monthly_panel(spark, sf_dir):
    """Bars of the days up to the 20th: later events find no row of their date."""
    return _raw_panel(spark, sf_dir).where(F.day("timestamp") <= 20)


@query
def split_factors_rolled(spark, sf_dir):
    """Splits count on the next date on which their symbol has a bar."""
    return actions.compute_split_factors(
        _monthly_panel(spark, sf_dir), _ratios(spark, sf_dir), roll_forward=True
    )


@query
def price_adjustments_rolled(spark, sf_dir):
    return actions.apply_price_adjustments(
        _monthly_panel(spark, sf_dir), _ratios(spark, sf_dir), _cash(spark, sf_dir),
        roll_forward=True,
    )


@query
def dividend_factors(spark, sf_dir):
    return actions.compute_dividend_factors(_raw_panel(spark, sf_dir), _cash(spark, sf_dir))


@query
def price_adjustments(spark, sf_dir):
    return actions.apply_price_adjustments(
        _raw_panel(spark, sf_dir),
        _ratios(spark, sf_dir),
        actions.build_cash_dividends(fx.dirty_dividends(spark, sf_dir)),
    )


@query
def volume_adjustments(spark, sf_dir):
    bars = fx.bars_1d(spark, sf_dir).select("timestamp", "symbol", "volume")
    return actions.apply_volume_adjustments(bars, _ratios(spark, sf_dir))


@query
def invalid_action_counts(spark, sf_dir):
    cash = actions.build_cash_dividends(fx.dirty_dividends(spark, sf_dir))
    signed = _ratios(spark, sf_dir).withColumn(
        "split_ratio", F.when(F.day("date") == 1, -F.col("split_ratio"))
        .otherwise(F.col("split_ratio"))
    )
    return actions.action_quality(
        actions.action_days(_raw_panel(spark, sf_dir), "close", signed, cash)
    )


@query
def daily_close_from_minutes(spark, sf_dir):
    return actions.daily_last(fx.bars_1min(spark, sf_dir), "close")


def _raw_panel(spark, sf_dir):
    """Bars as an undense panel: a symbol may lack a date that others have."""
    return fx.bars_1d(spark, sf_dir).select("timestamp", "symbol", "close")


# ---------------------------------------------------------------- normalisation and merge


@query
def raw_bars_normalised(spark, sf_dir):
    return normalize.normalize_bars(fx.raw_bars(fx.bars_1d(spark, sf_dir)))


@query
def raw_bars_micros(spark, sf_dir):
    """Bars whose vendor writes epoch microseconds."""
    raw_bars = fx.raw_bars(fx.bars_1d(spark, sf_dir))
    micros = raw_bars.withColumn("window_start", F.expr("window_start div 1000"))
    return normalize.normalize_bars(micros)


@query
def symbol_filter(spark, sf_dir):
    bars = normalize.normalize_bars(fx.raw_bars(fx.bars_1min(spark, sf_dir)))
    return normalize.for_symbols(bars, ["view", "error"]).select("timestamp", "symbol", "close")


@query
def reference_records(spark, sf_dir):
    return normalize.securities(fx.security_raw(spark, sf_dir))


@query
def reference_events(spark, sf_dir):
    records = fx.dividends(spark, sf_dir).withColumnRenamed("symbol", "ticker")
    day = F.col("ex_dividend_date")
    records = records.withColumn(
        "ex_dividend_date", F.when(F.col("event_id") % 13 == 0, F.lit("soon")).otherwise(day)
    )
    return normalize.dividend_events(records, date(1997, 1, 1), date(1999, 12, 31))


@query
def bars_dedup(spark, sf_dir):
    """Trades as competing bars of one day and symbol: the first by order key stays."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    trades = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("S"), (F.col("l_suppkey") % 10).cast("string")).alias("symbol"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
        order.alias(merge.INGEST_SEQ),
    )
    return merge.drop_duplicates_keep_first(trades, merge.BAR_KEY)


@query
def bars_merge_keep_existing(spark, sf_dir):
    """Daily bars up to 1999 merged with re-priced ones from 1997 on."""
    bars = fx.bars_1d(spark, sf_dir).select("timestamp", "symbol", "close", "volume")
    existing = bars.where(F.year("timestamp") <= 1999)
    again = bars.where(F.year("timestamp") >= 1997).select(
        "timestamp", "symbol", (F.col("close") * 2).alias("close"), F.lit(1).alias("revision")
    )
    return merge.merge_keep_existing(existing, again)


# ---------------------------------------------------------------- universe


@query
def universe_snapshot(spark, sf_dir):
    return universe.build_universe(fx.bars_1min(spark, sf_dir), F.to_date("timestamp"))


def _traded_parts(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("date"),
        F.col("l_partkey").cast("string").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.lit(1.0).alias("close"),
        F.col("l_quantity").alias("volume"),
    )


@query
def universe_wide_market(spark, sf_dir):
    """Every part traded on a day is a symbol: many symbols per day, ranked."""
    return universe.build_universe(_traded_parts(spark, sf_dir))


@query
def universe_top_n(spark, sf_dir):
    return universe.top_notional(fx.bars_1min(spark, sf_dir), 2, F.to_date("timestamp"))


@query
def universe_top_n_wide(spark, sf_dir):
    """The largest three parts of every day, of all that are traded."""
    return universe.top_notional(_traded_parts(spark, sf_dir), 3)


# ---------------------------------------------------------------- calendar


def _order_dates(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date"))


@query
def sessions_in_range(spark, sf_dir):
    """Sessions over the span of the orders, with the orders dated on each."""
    orders = _order_dates(spark, sf_dir)
    span = orders.agg(F.min("date").alias("lo"), F.max("date").alias("hi")).first()
    counts = orders.groupBy("date").agg(F.count("*").alias("n_orders"))
    days = sessions.trading_days(spark, span.lo, span.hi)
    return days.join(counts, "date", "left").fillna(0, ["n_orders"])


@query
def is_session(spark, sf_dir):
    return sessions.with_session_flag(_order_dates(spark, sf_dir), "date").groupBy(
        "date", "is_session"
    ).agg(F.count("*").alias("n_orders"))


@query
def session_times(spark, sf_dir):
    orders = sessions.only_sessions(_order_dates(spark, sf_dir).distinct(), "date")
    return orders.select(
        "date",
        cal.session_open("date").alias("open_ts"),
        cal.session_close("date").alias("close_ts"),
    )


@query
def session_minutes(spark, sf_dir):
    """Session minutes of the events' span, with the bars in each."""
    minutes = sessions.trading_minutes(spark, *MINUTE_SPAN)
    bars = fx.bars_1min(spark, sf_dir).groupBy("timestamp").agg(F.count("*").alias("n_bars"))
    return minutes.join(bars, "timestamp", "left").fillna(0, ["n_bars"])


@query
def next_session(spark, sf_dir):
    days = _order_dates(spark, sf_dir).distinct()
    return days.withColumn("next_session", cal.next_session("date"))


@query
def strictly_next_session(spark, sf_dir):
    days = _order_dates(spark, sf_dir).distinct()
    return days.withColumn("next_session", cal.strictly_next_session("date"))


@query
def previous_session(spark, sf_dir):
    days = _order_dates(spark, sf_dir).distinct()
    return days.withColumn("previous_session", cal.previous_session("date"))


@query
def previous_n_sessions(spark, sf_dir):
    days = _order_dates(spark, sf_dir).distinct()
    return days.select(
        "date", F.posexplode(cal.previous_sessions("date", 3)).alias("back", "session")
    )


# ---------------------------------------------------------------- ledger


@query
def ledger_is_complete(spark, sf_dir):
    return ledger.last_status(fx.ledger(spark, sf_dir))


@query
def ledger_missing(spark, sf_dir):
    days = sessions.sessions(spark, date(1995, 1, 1), date(2001, 8, 1)).select("date")
    return ledger.missing_days(days, fx.ledger(spark, sf_dir), "1min")


@query
def ledger_latest(spark, sf_dir):
    return ledger.latest_complete(fx.ledger(spark, sf_dir))


@query
def ledger_tail(spark, sf_dir):
    return ledger.tail(fx.ledger(spark, sf_dir), 50)


@query
def ledger_gaps(spark, sf_dir):
    return ledger.gap_report(fx.ledger(spark, sf_dir), "1d", date(2001, 8, 1))


@query
def update_windows(spark, sf_dir):
    return ledger.window_report(
        fx.ledger(spark, sf_dir), ["1d", "1min"], date(1995, 1, 1), date(2001, 8, 1)
    )


# ---------------------------------------------------------------- files, lake, jobs


def _lake(spark, name):
    return Lake(spark, scratch_path(spark, name))


def _landed(spark, sf_dir, name, *freqs):
    """A new lake with raw day files of the given frequencies."""
    lake = _lake(spark, name)
    make = {"1min": fx.bars_1min, "1d": fx.bars_event_days}
    for freq in freqs:
        fx.land_raw_files(make[freq](spark, sf_dir), raw.raw_root(lake.root, VENDOR, freq))
    return lake


@query
def raw_file_audit(spark, sf_dir):
    lake = _landed(spark, sf_dir, "audit", "1d")
    files = jobs.RawSource(VENDOR).files(lake, "1d")
    days = sessions.trading_days(spark, date(2023, 12, 18), date(2024, 2, 9))
    return raw.audit_files(days, files).select("date", "present", "files")


@query
def job_backfill(spark, sf_dir):
    lake = _landed(spark, sf_dir, "backfill", "1min")
    jobs.backfill_bars(lake, jobs.RawSource(VENDOR), *MINUTE_DATES, "1min")
    return src.scan_bars(lake, "1min")


def _untidy(spark, sf_dir, name):
    """Landed minute files with null stamps, counts written as 12.0, and one day of no CSV."""
    lake = _lake(spark, name)
    bars = fx.bars_1min(spark, sf_dir).withColumn("n_trades", F.col("n_trades").cast("double"))
    nameless = bars.where(F.minute("timestamp") % 5 == 0).withColumn("symbol", F.lit("LOST"))
    root = raw.raw_root(lake.root, VENDOR, "1min")
    good = F.to_date("timestamp") != F.lit(BROKEN_DAY)
    fx.land_raw_files(bars.where(good), root, nameless.where(good))
    fx.land_broken_day(spark, root, BROKEN_DAY)
    return lake


def _backfilled_twice(spark, sf_dir, name):
    lake = _untidy(spark, sf_dir, name)
    for _ in range(2):
        jobs.backfill_bars(lake, jobs.RawSource(VENDOR), *MINUTE_DATES, "1min")
    return lake


@query
def job_backfill_untidy(spark, sf_dir):
    """Bars of untidy files, ingested twice: good days are whole, rows without a stamp absent."""
    return src.scan_bars(_backfilled_twice(spark, sf_dir, "untidy"), "1min")


@query
def job_backfill_ledger(spark, sf_dir):
    """Last status of each day of that backfill."""
    lake = _backfilled_twice(spark, sf_dir, "untidy-ledger")
    return ledger.last_status(src.load_ledger(lake)).select("date", "freq", "status")


def _updated(spark, sf_dir, name):
    """First update in two runs: the second continues where the first one ended."""
    lake = _landed(spark, sf_dir, name, "1d", "1min")
    source = jobs.RawSource(VENDOR)
    landed = scratch_path(spark, "records")
    fx.land_records(spark, sf_dir, landed)
    kinds = ("securities", "splits", "dividends")
    reference = jobs.ReferenceSource(
        *[lambda kind=kind: read_records(spark, f"{landed}/{kind}.parquet") for kind in kinds]
    )
    first = date(2024, 1, 1)
    windows = [
        jobs.run_incremental_update(lake, source, None, first, end, reference=reference)
        for end in (date(2024, 1, 12), date(2024, 1, 31))
    ]
    return lake, windows


@query
def job_incremental(spark, sf_dir):
    """Snapshots of an update in two runs."""
    return src.load_universe(_updated(spark, sf_dir, "update")[0])


@query
def job_incremental_bars(spark, sf_dir):
    """Daily and minute bars of an update in two runs."""
    lake, _ = _updated(spark, sf_dir, "update-bars")
    day, minute = (
        src.scan_bars(lake, freq).withColumn("freq", F.lit(freq)) for freq in ("1d", "1min")
    )
    return day.union(minute)


@query
def job_incremental_actions(spark, sf_dir):
    """Action tables of an update in two runs, from landed records."""
    lake, _ = _updated(spark, sf_dir, "update-actions")
    ratios = src.load_split_ratio_table(lake).select(
        F.lit("split").alias("kind"), "date", "symbol", F.col("split_ratio").alias("amount")
    )
    cash = src.load_dividend_cash_table(lake).select(
        F.lit("dividend"), "date", "symbol", "cash_amount"
    )
    return ratios.union(cash)


@query
def job_incremental_windows(spark, sf_dir):
    """What the two updates say they did."""
    _, (first, second) = _updated(spark, sf_dir, "update-windows")
    return first.withColumn("run", F.lit(1)).union(second.withColumn("run", F.lit(2)))


@query
def lake_universe(spark, sf_dir):
    """The largest symbols of one stored snapshot."""
    lake = _landed(spark, sf_dir, "snapshot", "1d")
    jobs.backfill_bars(
        lake, jobs.RawSource(VENDOR), *MINUTE_DATES, "1d", write_universe_snapshots=True
    )
    return prices.get_universe(lake, SNAPSHOT_DAY, 3)


@query
def stream_ingest(spark, sf_dir):
    lake = _landed(spark, sf_dir, "stream", "1min")
    run = stream_bars(
        lake, jobs.RawSource(VENDOR), "1min", fx.RAW_COLUMNS, scratch_path(spark, "offsets")
    )
    run.awaitTermination()
    return src.scan_bars(lake, "1min")


@query
def stream_universe(spark, sf_dir):
    """Snapshots of a stream that takes one file at a time, each day in several files."""
    lake = _lake(spark, "stream-days")
    root = raw.raw_root(lake.root, VENDOR, "1d")
    fx.land_raw_files(fx.bars_event_days(spark, sf_dir), root, files_per_day=3)
    run = stream_bars(
        lake, jobs.RawSource(VENDOR), "1d", fx.RAW_COLUMNS, scratch_path(spark, "offsets"),
        write_universe_snapshots=True, max_files_per_trigger=20,
    )
    run.awaitTermination()
    return src.load_universe(lake)


@query
def lake_adjusted_prices(spark, sf_dir):
    """Bars and events written to a lake twice, then read back adjusted."""
    lake = _lake(spark, "prices")
    for _ in range(2):
        sink.write_bars(lake, fx.bars_1d(spark, sf_dir), "1d")
    order = F.col("event_id").alias(merge.INGEST_SEQ)
    sink.write_splits(lake, fx.splits(spark, sf_dir).select("*", order))
    sink.write_dividends(lake, fx.dividends(spark, sf_dir).select("*", order))
    sink.build_corporate_actions_tables(lake)
    return prices.load_adjusted_prices(lake, "1d", fx.DAILY_SYMBOLS, *DAILY_SPAN)


@query
def lake_event_merge(spark, sf_dir):
    """Dividends merged twice by symbol and date: the first event of a key stays."""
    lake = _lake(spark, "events")
    order = F.col("event_id").alias(merge.INGEST_SEQ)
    records = fx.dividends(spark, sf_dir).select("*", order)
    early = records.where(F.col("ex_dividend_date") < "1998-07-01")
    sink.write_dividends(lake, early)
    sink.write_dividends(lake, records.withColumn("cash_amount", F.col("cash_amount") + 1))
    return src.load_dividends(lake)


@query
def lake_security_master(spark, sf_dir):
    """Securities merged twice: a changed activity flag does not overwrite the first, and a
    column of the vendor's own comes back."""
    lake = _lake(spark, "master")
    records = fx.security_raw(spark, sf_dir).withColumn("cik", F.concat(F.lit("C-"), "name"))
    jobs.sync_security_master(lake, records)
    jobs.sync_security_master(lake, records.withColumn("active", ~F.col("active")))
    return src.load_security_master(lake)


FIRST_ISSUE, CORRECTION = date(2002, 1, 1), date(2002, 7, 1)


def _issued(lake, records, corrected, write):
    """Records written, and written again with corrections half a year later."""
    write(lake, records, mode="upsert", at=FIRST_ISSUE)
    write(lake, corrected, mode="upsert", at=CORRECTION)


@query
def merge_upsert_security_master(spark, sf_dir):
    """Every version of the securities after four batches: all, half with another flag, the
    same again, and one exchange renamed."""
    lake = _lake(spark, "versions")
    records = fx.security_raw(spark, sf_dir)
    flipped = records.withColumn(
        "active", F.when(F.substring("ticker", -1, 1) < "5", ~F.col("active")).otherwise(F.col("active"))
    )
    renamed = flipped.withColumn(
        "primary_exchange", F.when(F.col("primary_exchange") == "FRANCE", F.lit("PARIS"))
        .otherwise(F.col("primary_exchange"))
    )
    for day, batch in ((1, records), (2, flipped), (3, flipped), (4, renamed)):
        jobs.sync_security_master(lake, batch, mode="upsert", at=date(2024, 1, day))
    return src.load_history(lake, "security_master").drop("sector", "industry")


@query
def security_as_of(spark, sf_dir):
    """Orders with the activity of a security as it was known on the day of the order."""
    lake = _lake(spark, "as-of")
    records = fx.security_raw(spark, sf_dir)
    middle = date(1998, 1, 1)
    jobs.sync_security_master(lake, records, mode="upsert", at=date(1995, 1, 1))
    changed = records.withColumn("active", ~F.col("active"))
    jobs.sync_security_master(lake, changed, mode="upsert", at=middle)
    orders = fx.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("S"), (F.col("o_custkey") % 10 + 1).cast("string")).alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    )
    history = src.load_history(lake, "security_master").select(
        "symbol", "is_active", *versions.PERIOD
    )
    known = versions.join_versions(orders, history, ["symbol"], "timestamp")
    return known.groupBy("symbol", F.year("timestamp").alias("year"), "is_active").agg(
        F.count("*").alias("n_orders")
    )


@query
def adjusted_close_panel_as_of(spark, sf_dir):
    """Closes adjusted by the events as known before and after they were corrected."""
    lake = _lake(spark, "known")
    sink.write_bars(lake, fx.bars_1d(spark, sf_dir), "1d")
    order = F.col("event_id").alias(merge.INGEST_SEQ)
    sink.write_splits(lake, fx.splits(spark, sf_dir).select("*", order))
    records = fx.dividends(spark, sf_dir).select("*", order)
    raised = F.when(F.col("event_id") % 5 == 0, F.col("cash_amount") + 1).otherwise(F.col("cash_amount"))
    _issued(lake, records, records.withColumn("cash_amount", raised), sink.write_dividends)
    known = [
        prices.load_adjusted_prices(
            lake, "1d", fx.DAILY_SYMBOLS, *DAILY_SPAN, as_of=day
        ).withColumn("as_of", F.lit(day))
        for day in (date(2002, 3, 1), date(2003, 1, 1))
    ]
    return known[0].union(known[1])


@query
def lake_adjusted_prices_by_symbol(spark, sf_dir):
    """Adjusted closes from daily bars in buckets by symbol, half of them merged later."""
    lake = _lake(spark, "by-symbol")
    bars = fx.bars_1d(spark, sf_dir)
    early = F.year("timestamp") < 1998
    sink.write_bars(lake, bars.where(early), "1d")
    sink.lay_out_by_symbol(lake, 8)
    sink.write_bars(lake, bars, "1d")
    order = F.col("event_id").alias(merge.INGEST_SEQ)
    sink.write_splits(lake, fx.splits(spark, sf_dir).select("*", order))
    sink.write_dividends(lake, fx.dividends(spark, sf_dir).select("*", order))
    sink.build_corporate_actions_tables(lake)
    return prices.load_adjusted_prices(lake, "1d", fx.DAILY_SYMBOLS, *DAILY_SPAN, layout="symbol")


@query
def lake_symbol_lookup(spark, sf_dir):
    """Stored bars of one part of a market in which every part traded is a symbol."""
    lake = _lake(spark, "lookup")
    trades = fx.table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    stamp = F.col("l_shipdate").cast("timestamp").alias("timestamp")
    bars = trades.groupBy(stamp, F.col("l_partkey").cast("string").alias("symbol")).agg(
        *[agg(price).alias(f) for f, agg in (("open", F.min), ("high", F.max), ("low", F.min), ("close", F.max))],
        F.max(price).alias("vwap"),
        F.sum("l_quantity").alias("volume"),
        F.count("*").alias("n_trades"),
    )
    sink.write_bars(lake, bars, "1d")
    found = src.scan_bars(lake, "1d")
    return normalize.for_symbols(found, ["17", "42", "no such"]).select("timestamp", "symbol", "close", "volume")


@query
def stream_universe_windowed(spark, sf_dir):
    """Universes of the days that a stream over stored bars has closed, after three runs; bars
    of a day that was closed before come too late."""
    lake, first = _lake(spark, "windows"), F.lit(MINUTE_DATES[0])
    bars = fx.bars_1min(spark, sf_dir)
    third = F.floor(F.datediff(F.to_date("timestamp"), first) / 10)
    late = bars.where(F.to_date("timestamp") == F.lit(date(2024, 1, 3))).withColumn("symbol", F.lit("late"))
    offsets = scratch_path(spark, "window-offsets")
    for i in range(3):
        batch = bars.where(third >= 2 if i == 2 else third == i)
        sink.write_bars(lake, batch.union(late) if i == 2 else batch, "1min")
        stream_daily_universe(lake, "1min", offsets, delay="3 days").awaitTermination()
    return src.load_universe(lake)


@query
def raw_parquet_bars(spark, sf_dir):
    """Raw day files in Parquet, under the vendor's own names."""
    root = scratch_path(spark, "raw-parquet")
    day = F.to_date(F.timestamp_micros(F.expr("window_start div 1000"))).alias("day")
    raw_bars = fx.raw_bars(fx.bars_event_days(spark, sf_dir)).select("*", day)
    raw_bars.repartition("day").write.partitionBy("day").parquet(root)
    files = raw.list_files(spark, root, "parquet")
    paths = [r.path for r in files.select("path").orderBy("path").collect()]
    bars = raw.bars_from_files(spark, paths)
    return bars.select("timestamp", "symbol", "close", "vwap", "volume", "n_trades", raw.TRADING_DAY)


@query
def universe_days(spark, sf_dir):
    """Notionals of a day by the day of its file, and the ledger's days that follow it."""
    missing = ledger.missing_days(
        sessions.sessions(spark, *MINUTE_DATES).select("date"), fx.ledger(spark, sf_dir), "1d"
    )
    notional = universe.daily_notional(fx.bars_event_days(spark, sf_dir), F.to_date("timestamp"))
    return notional.join(missing, "date", "left_semi")


@query
def source_day_files(spark, sf_dir):
    """Landed minute files through the data source, one task a file."""
    root = scratch_path(spark, "day-files")
    fx.land_raw_files(fx.bars_1min(spark, sf_dir), root)
    bars = normalize.normalize_bars(read_day_files(spark, root), per=raw.SOURCE_FILE)
    return bars.select("timestamp", "symbol", "close", "volume", "n_trades", raw.TRADING_DAY)


@query
def source_day_stream(spark, sf_dir):
    """Bars that a stream over the data source brings to the lake, each day in several files."""
    lake = _lake(spark, "day-stream")
    root = raw.raw_root(lake.root, VENDOR, "1min")
    fx.land_raw_files(fx.bars_1min(spark, sf_dir), root, files_per_day=3)
    rows = stream_day_files(spark, root, fx.RAW_COLUMNS, settle_seconds=0)

    def take(batch, _):
        sink.write_bars(lake, normalize.normalize_bars(batch, per=raw.SOURCE_FILE), "1min")

    run = rows.writeStream.foreachBatch(take).trigger(availableNow=True)
    run.option("checkpointLocation", scratch_path(spark, "offsets")).start().awaitTermination()
    return src.scan_bars(lake, "1min")
