"""Ingestion jobs: backfill, reference data, incremental update.

A backfill is one Spark job over all missing days, not a loop of days: files are listed
and matched to the calendar as tables, parsed in one scan, staged once, and merged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import freq_checked
from tickloom.operators import ledger as led
from tickloom.operators import normalize, sessions
from tickloom.operators.normalize import for_symbols
from tickloom.operators.universe import build_universe
from tickloom.schemas import FREQS
from tickloom.session import scratch_run, stage
from tickloom.sinks import lake as sink
from tickloom.sources import raw
from tickloom.sources.lake import Lake, load_ledger, trading_day_bars

RESULT_COLUMNS = (
    "freq string, start date, end date, expected bigint, present bigint, missing bigint, "
    "partitions bigint, reference_synced boolean, corporate_actions_start date"
)

#: Days staged together by default: about a year of sessions.
DAYS_PER_RUN = 250


@dataclass(frozen=True)
class RawSource:
    """Day files of one vendor below ``<lake>/raw/<vendor>``."""

    vendor: str
    prefix: str | None = None
    ext: str = "csv.gz"

    def files(
        self, lake: Lake, freq: str, start: date | None = None, end: date | None = None
    ) -> DataFrame:
        root = raw.raw_root(lake.root, self.vendor, freq, self.prefix)
        return raw.list_files(lake.spark, root, self.ext, start, end)


@dataclass(frozen=True)
class BackfillResult:
    """What a backfill did: days planned, ingested and failed, partitions touched, and why
    days that have files failed."""

    planned: list[date]
    ingested: list[date]
    failed: list[date]
    partitions: list[str]
    errors: dict[date, Exception] = field(default_factory=dict)


@dataclass(frozen=True)
class IngestedBars:
    """The staged bars of one run and the lake partitions they touched."""

    staged: DataFrame
    partitions: list[str]


def planned_files(
    lake: Lake, source: RawSource, start: date, end: date, freq: str
) -> list[tuple[date, str | None]]:
    """Missing sessions and their files, a null path where there is none.

    Collected, because a scan takes its paths from the driver: one row per file of a day.
    """
    days = sessions.sessions(lake.spark, start, end).select("date")
    missing = led.missing_days(days, load_ledger(lake), freq)
    rows = missing.join(source.files(lake, freq, start, end), "date", "left").select("date", "path")
    return sorted(((r.date, r.path) for r in rows.collect()), key=lambda r: (r[0], r[1] or ""))


def backfill_bars(
    lake: Lake,
    source: RawSource,
    start: date,
    end: date,
    freq: str,
    symbols: list[str] | None = None,
    write_universe_snapshots: bool = False,
    fail_fast: bool = False,
    days_per_run: int = DAYS_PER_RUN,
) -> BackfillResult:
    """Ingest every session in the range that was never completed.

    A day without a raw file, or whose files cannot be read, is logged as failed and the
    other days complete; the result tells why. With ``fail_fast`` the run ends there with an
    error. ``days_per_run`` cuts a long history into several
    runs, which bounds the staged data; it does not change the result.
    """
    plan = planned_files(lake, source, start, end, freq_checked(freq))
    absent = sorted({d for d, path in plan if path is None})
    if fail_fast and absent:
        plan = [(d, path) for d, path in plan if d <= absent[0]]
        absent = absent[:1]
    planned = sorted({d for d, _ in plan})
    partitions: list[str] = []
    errors: dict[date, Exception] = {}
    for i in range(0, len(planned), days_per_run):
        part = set(planned[i : i + days_per_run])
        run = [(d, path) for d, path in plan if d in part]
        done, bad = _backfill_run(lake, run, freq, symbols, write_universe_snapshots)
        partitions += done
        errors |= bad
        if fail_fast and errors:
            break
    found = [d for d in planned if d not in {*absent, *errors}]
    if fail_fast and errors:
        raise errors[min(errors)]
    if fail_fast and absent:
        raise FileNotFoundError(f"no raw file of {absent[0]} at {freq}")
    return BackfillResult(
        planned, found, sorted({*absent, *errors}), sorted(set(partitions)), errors
    )


def _backfill_run(
    lake: Lake,
    plan: list[tuple[date, str | None]],
    freq: str,
    symbols: list[str] | None,
    snapshots: bool,
) -> tuple[list[str], dict[date, Exception]]:
    """Ingest the days of one run; partitions touched, and the days that could not be read."""
    days = {d for d, _ in plan}
    files = [(d, path) for d, path in plan if path is not None]
    sink.record_days(lake, freq, {led.STARTED: _days_frame(lake, days)})
    partitions, errors = _ingest_files(lake, files, freq, symbols, snapshots)
    found = {d for d, _ in files} - set(errors)
    outcome = {led.COMPLETE: _days_frame(lake, found), led.FAILED: _days_frame(lake, days - found)}
    sink.record_days(lake, freq, outcome)
    return partitions, errors


def _ingest_files(
    lake: Lake,
    files: list[tuple[date, str]],
    freq: str,
    symbols: list[str] | None,
    snapshots: bool,
) -> tuple[list[str], dict[date, Exception]]:
    """All files in one job; if files cannot be read, each half of the days, down to the day that
    is bad. Any other failure is raised at once, and the days stay as started.

    Merges keep existing rows, so what a failed attempt had written is not written again.
    """
    if not files:
        return [], {}
    try:
        with scratch_run(lake.spark, lake.path("staging")):
            bars = raw.bars_from_files(lake.spark, [path for _, path in files], materialize=True)
            return ingest(lake, for_symbols(bars, symbols), freq, snapshots).partitions, {}
    except Exception as error:  # noqa: BLE001 - whatever a reader or writer raises
        if _readable(lake, files, symbols):
            raise  # a full disk, a lost cluster: fewer days would not help
        days = sorted({d for d, _ in files})
        if len(days) == 1:
            return [], {days[0]: error}
    middle = days[len(days) // 2]
    halves = [f for f in files if f[0] < middle], [f for f in files if f[0] >= middle]
    done = [_ingest_files(lake, half, freq, symbols, snapshots) for half in halves]
    return done[0][0] + done[1][0], done[0][1] | done[1][1]


def _readable(lake: Lake, files: list[tuple[date, str]], symbols: list[str] | None) -> bool:
    """Whether files can be read, parsed and validated, so that a failure was none of theirs.
    A stopped session can tell nothing about files."""
    if lake.spark.sparkContext._jsc.sc().isStopped():
        return True
    try:
        bars = raw.bars_from_files(lake.spark, [path for _, path in files])
        sink.unique_bars(for_symbols(bars, symbols)).write.format("noop").mode("overwrite").save()
    except Exception:  # noqa: BLE001 - the caller tells why
        return False
    return True


def _days_frame(lake: Lake, days: set[date]) -> DataFrame:
    return lake.spark.createDataFrame([(d,) for d in sorted(days)], "date date")


def ingest(lake: Lake, bars: DataFrame, freq: str, snapshots: bool) -> IngestedBars:
    """Deduplicate, stage, merge and, if asked, rank normalised bars of raw files.

    Bars are stored with the trading day of their source file. The days touched are ranked
    from all of their bars in the lake, however many runs or batches brought them in.
    """
    unique = sink.unique_bars(bars.drop(raw.SOURCE_FILE))
    staged = stage(sink.with_partition(unique, freq), f"ingest-{freq}")
    partitions = sink.write_staged_bars(lake, staged, freq)
    if snapshots:
        days = [r[0] for r in staged.select(raw.TRADING_DAY).distinct().collect()]
        rank_days(lake, [d for d in days if d is not None], freq)
    return IngestedBars(staged, partitions)


def rank_days(lake: Lake, days: list[date], freq: str) -> None:
    """Rank trading days from the stored bars and replace their snapshots."""
    if days:
        bars = trading_day_bars(lake, freq, days)
        sink.replace_universe(lake, build_universe(bars, F.col(raw.TRADING_DAY)))


def sync_security_master(
    lake: Lake, records: DataFrame, mode: str = "keep", at: datetime | date | None = None
) -> str:
    """Security records into the security master; ``mode="upsert"`` lets re-issued ones win."""
    return sink.write_security_master(lake, normalize.securities(records), mode, at)


def sync_corporate_actions(
    lake: Lake,
    splits: DataFrame,
    dividends: DataFrame,
    start: date | None = None,
    end: date | None = None,
    mode: str = "keep",
    at: datetime | date | None = None,
) -> list[str]:
    """Split and dividend records, within a range, into the event tables; with
    ``mode="upsert"`` corrected events win from ``at`` (default: now) on."""
    return [
        sink.write_splits(lake, normalize.split_events(splits, start, end), mode, at),
        sink.write_dividends(lake, normalize.dividend_events(dividends, start, end), mode, at),
    ]


@dataclass(frozen=True)
class ReferenceSource:
    """Functions that return the landed records of each kind."""

    securities: Callable[[], DataFrame]
    splits: Callable[[], DataFrame]
    dividends: Callable[[], DataFrame]


def run_incremental_update(
    lake: Lake,
    source: RawSource,
    freqs: list[str] | None = None,
    fallback_start: date | None = None,
    end: date | None = None,
    write_universe: bool = True,
    reference: ReferenceSource | None = None,
    fail_fast: bool = False,
    days_per_run: int = DAYS_PER_RUN,
) -> DataFrame:
    """Bring the lake up to the last session before today (or ``end``).

    Each frequency continues after its latest complete day; snapshots are written for
    daily bars. With a reference source the security master is always merged; splits and
    dividends only if a frequency had work, from the earliest window start on. The action
    tables are then rebuilt from all stored events up to ``end``, so that events before
    the window stay in them.

    Returns one row per frequency: window, files expected, present and missing, and
    partitions touched; nulls and zeros for a frequency that was current. Each row also tells
    whether reference data ran and from which day on actions were synced.
    """
    freqs = list(dict.fromkeys(freqs or FREQS))
    update_end = end or led.default_update_end(lake.spark)
    planned = led.update_windows(load_ledger(lake), freqs, fallback_start, update_end)
    windows = {w.freq: w for w in planned.collect()}
    results = []
    for freq in freqs:
        window = windows.get(freq)
        if window is None:
            results.append((freq, None, None, 0, 0, 0, 0))
            continue
        done = backfill_bars(
            lake,
            source,
            window.start,
            window.end,
            freq,
            write_universe_snapshots=write_universe and freq == "1d",
            fail_fast=fail_fast,
            days_per_run=days_per_run,
        )
        results.append(
            (
                freq,
                window.start,
                window.end,
                len(done.planned),
                len(done.ingested),
                len(done.failed),
                len(done.partitions),
            )
        )
    first = None
    if reference is not None:
        sync_security_master(lake, reference.securities())
        first = led.earliest_start([w.start for w in windows.values()])
        if first is not None:
            sync_corporate_actions(
                lake, reference.splits(), reference.dividends(), first, update_end
            )
            sink.build_corporate_actions_tables(lake, end=update_end)
    told = [(*r, reference is not None, first) for r in results]
    return lake.spark.createDataFrame(told, RESULT_COLUMNS)
