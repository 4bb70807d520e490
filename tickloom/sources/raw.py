"""Raw day files: listing, choice of layout, scan."""

from __future__ import annotations

import re
from datetime import date
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.scalars import freq_checked, in_range
from tickloom.operators.merge import with_ingest_order
from tickloom.operators.normalize import normalize_bars, rename_bars
from tickloom.session import children, stage

# Dataset folder of each frequency below the vendor's folder.
DATASETS = {
    "1d": "us_stocks_sip/day_aggs_v1",
    "1min": "us_stocks_sip/minute_aggs_v1",
}
DATASET_MARKS = {"1d": "day_aggs", "1min": "minute_aggs"}

SOURCE_FILE = "source_file"
TRADING_DAY = "trading_day"

_LISTING = "path string, length bigint"


def dataset_for(freq: str, prefix: str | None = None) -> str:
    """The dataset folder: the given one if it fits the frequency, else the default."""
    freq_checked(freq)
    return prefix if prefix and DATASET_MARKS[freq] in prefix else DATASETS[freq]


def file_key(prefix: str, day: date, ext: str = "csv.gz") -> str:
    """Object key of a day file: ``prefix/YYYY/MM/YYYY-MM-DD.ext``."""
    return f"{prefix}/{day:%Y/%m}/{day.isoformat()}.{ext}"


def raw_root(lake_root: str, vendor: str, freq: str, prefix: str | None = None) -> str:
    """Folder that holds the day files of one vendor and frequency."""
    return f"{lake_root.rstrip('/')}/raw/{vendor}/{dataset_for(freq, prefix)}"


def file_day(path: Column | str) -> Column:
    """Trading day of a raw file: the last ISO date in its path."""
    path = F.col(path) if isinstance(path, str) else path
    found = F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})(?!.*\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", found).try_cast("date")


def _layout(path: Column, day: Column) -> Column:
    """0 primary ``YYYY/MM/day.ext``, 1 legacy ``YYYY/MM/day/day.ext``, 2 a folder per day
    with files of any name (how Spark writes a partitioned landing table)."""
    iso, month = day.cast("string"), F.date_format(day, "yyyy/MM")
    named = F.concat(F.lit("/"), iso, F.lit("."))
    primary = F.concat(F.lit("/"), month, named)
    legacy = F.concat(F.lit("/"), month, F.lit("/"), iso, named)
    return (
        F.when(F.contains(path, legacy), 1)
        .when(F.contains(path, primary), 0)
        .otherwise(2)
    )


def window_folders(spark: SparkSession, root: str, start: date, end: date) -> list[str]:
    """What below a folder can hold day files of a range.

    Of folders named by year and month, and of names with a date, those of the range; whatever
    has another name, whole. Only the years and the months of the range's years are listed here.
    """
    months = {f"{y}/{m:02d}" for y in range(start.year, end.year + 1) for m in range(1, 13)
              if (start.year, start.month) <= (y, m) <= (end.year, end.month)}
    found = []
    for name in children(spark, root):
        dates = re.findall(r"\d{4}-\d{2}-\d{2}", name)
        if re.fullmatch(r"\d{4}", name):
            if start.year <= int(name) <= end.year:
                below = [f"{name}/{m}" for m in children(spark, f"{root}/{name}")]
                found += [b for b in below if b in months or not re.fullmatch(r"\d{4}/\d{2}", b)]
        elif not dates or start.isoformat() <= dates[-1] <= end.isoformat():
            found.append(name)
    return [f"{root}/{name}" for name in found]


def list_files(
    spark: SparkSession,
    root: str,
    ext: str = "csv.gz",
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """``(path, length, date)`` of the day files under a folder, contents unread.

    Where a day exists in several layouts only the preferred one stays. A missing folder
    gives an empty listing. With ``start`` and ``end`` only days between them are given, and
    only folders that can hold them are listed: a long history is not walked for one window.
    """
    roots = [root] if start is None or end is None else window_folders(spark, root, start, end)
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*.{ext}")
            .load(roots)
            .select("path", "length")
        ) if roots else spark.createDataFrame([], _LISTING)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], _LISTING)
    files = files.withColumn("date", file_day("path")).where(F.col("date").isNotNull())
    files = files.where(in_range(F.col("date"), start, end))
    files = files.withColumn("_layout", _layout(F.col("path"), F.col("date")))
    best = files.groupBy("date").agg(F.min("_layout").alias("_best"))
    return (
        files.join(best, "date")
        .where(F.col("_layout") == F.col("_best"))
        .select("path", "length", "date")
    )


def audit_files(sessions: DataFrame, files: DataFrame) -> DataFrame:
    """``(date, present, files, bytes)`` for every session: is its raw file there?"""
    have = files.groupBy("date").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
    return sessions.select("date").join(have, "date", "left").select(
        "date",
        F.col("files").isNotNull().alias("present"),
        F.coalesce("files", F.lit(0)).cast("bigint").alias("files"),
        F.coalesce("bytes", F.lit(0)).cast("bigint").alias("bytes"),
    )


def file_format(path: str) -> str:
    """Reader for a file name: gzip or plain CSV, or Parquet."""
    suffixes = PurePosixPath(path).suffixes
    if suffixes[-2:] == [".csv", ".gz"] or suffixes[-1:] == [".csv"]:
        return "csv"
    if suffixes[-1:] == [".parquet"]:
        return "parquet"
    raise ValueError(f"no reader for {PurePosixPath(path).name}")


def scan_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All files in one scan, with their source file, trading day and input order.

    CSV columns are read as text, never inferred, so tickers such as ``NA`` or ``TRUE``
    stay text. Names come from the first file's header; a file with another header fails
    rather than being misread.
    """
    kinds = {file_format(p) for p in paths}
    if len(kinds) != 1:
        raise ValueError(f"one scan reads one file format, got {sorted(kinds)}")
    if kinds == {"csv"}:
        header = spark.read.option("header", "true").csv(paths[0]).schema
        raw = (
            spark.read.schema(header)
            .option("header", "true")
            .option("enforceSchema", "false")
            .csv(paths)
        )
    else:
        raw = spark.read.option("mergeSchema", "true").parquet(*paths)
    return with_source(rename_bars(raw), F.col("_metadata.file_path"),
                       F.col("_metadata.file_block_start"))


def with_source(raw: DataFrame, path: Column, block: Column) -> DataFrame:
    """Attach source file, trading day and input order."""
    out = raw.withColumns({SOURCE_FILE: path, "_block": block})
    out = out.withColumn(TRADING_DAY, file_day(SOURCE_FILE))
    order = [F.col(TRADING_DAY), F.col(SOURCE_FILE), F.col("_block")]
    return with_ingest_order(out, *order).drop("_block")


def bars_from_files(
    spark: SparkSession, paths: list[str], materialize: bool = False
) -> DataFrame:
    """Normalised bars of raw day files, epoch units decided per file.

    The unit needs a first look at every file. With ``materialize`` the parsed rows are
    staged as Parquet, so that text is decompressed and parsed once and the input order is
    fixed once; the first look then reads one column of the staged table.
    """
    return normalize_scan(scan_files(spark, paths), materialize)


def normalize_scan(raw: DataFrame, materialize: bool) -> DataFrame:
    """``normalize_bars`` per source file of a scan, optionally staged before."""
    if materialize:
        raw = stage(raw, "raw")
    return normalize_bars(raw, per=SOURCE_FILE)


def fetch_day(
    spark: SparkSession,
    lake_root: str,
    vendor: str,
    day: date,
    freq: str,
    prefix: str | None = None,
    ext: str = "csv.gz",
) -> DataFrame:
    """Normalised bars of one trading day; a missing file is an error."""
    root = raw_root(lake_root, vendor, freq, prefix)
    found = list_files(spark, root, ext, day, day).collect()
    if not found:
        raise FileNotFoundError(f"no raw file of {day} below {root}")
    return bars_from_files(spark, sorted(r.path for r in found))
