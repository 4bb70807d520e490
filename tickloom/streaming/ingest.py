"""Structured Streaming form of the backfill.

A file-source stream over the landing folder normalises each batch of day files and merges
it. The checkpoint remembers which files were taken; a batch replayed after a failure
inserts nothing twice, because the merge keeps existing rows. The query itself holds no
state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import calendar as cal
from tickloom.functions.scalars import freq_checked
from tickloom.operators import ledger as led
from tickloom.operators.normalize import canonical_names
from tickloom.plans.jobs import RawSource, ingest
from tickloom.session import scratch_run
from tickloom.sinks import lake as sink
from tickloom.sources import raw
from tickloom.sources.lake import Lake, load_ledger

_PATH, _BLOCK = "_path", "_start"


def stream_bars(
    lake: Lake,
    source: RawSource,
    freq: str,
    columns: list[str],
    checkpoint: str,
    write_universe_snapshots: bool = False,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Ingest all files in the landing folder that were not taken before, then stop.

    ``columns`` is the header of the day files, in order; another header fails. Only files
    of trading days are ingested. A day that arrives again, or in several files, adds the
    bars it did not have yet, and is ranked anew from all of its bars.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    files = (
        lake.spark.readStream.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{source.ext}")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .csv(raw.raw_root(lake.root, source.vendor, freq_checked(freq), source.prefix))
    )

    def take(batch: DataFrame, _: int) -> None:
        with scratch_run(lake.spark, lake.path("staging")):
            _ingest_batch(lake, batch, freq, write_universe_snapshots)

    return (
        files.select("*", F.col("_metadata.file_path").alias(_PATH),
                     F.col("_metadata.file_block_start").alias(_BLOCK))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _ingest_batch(lake: Lake, batch: DataFrame, freq: str, snapshots: bool) -> None:
    vendor = [c for c in batch.columns if c not in (_PATH, _BLOCK)]
    names = dict(zip(vendor, canonical_names(vendor), strict=True))
    renamed = batch.toDF(*[names.get(c, c) for c in batch.columns])
    rows = raw.with_source(renamed, F.col(_PATH), F.col(_BLOCK)).drop(_PATH, _BLOCK)
    rows = rows.where(cal.is_session(raw.TRADING_DAY))
    bars = raw.normalize_scan(rows, materialize=True)
    staged = ingest(lake, bars, freq, snapshots).staged
    days = staged.select(F.col(raw.TRADING_DAY).alias("date")).distinct()
    fresh = led.missing_days(days, load_ledger(lake), freq)
    sink.record_days(lake, freq, {led.COMPLETE: fresh})
