"""Day files of a vendor as a Spark data source, for batch reads and streams.

    raw = read_day_files(spark, "/data/lake/raw/vendor/day_aggs", start=date(2024, 1, 2), symbols=["AAPL"])
    bars = normalize_bars(raw, per="source_file")

A provider with files of another form derives from ``DayFiles``, gives it another ``name`` and
overrides ``files`` or ``batches``. The scans in ``raw`` read the forms that Spark knows by
itself and stay the faster way to them; this source adds what they cannot: a provider sees the
days and symbols asked for, and a stream takes a file again when it was replaced.

Days and symbols are options of the read. Spark 4.1 can push conditions to a Python source, but
keeps those of one query with the loaded frame: a second query of the same frame then lacks rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date
from time import time_ns

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv, fs, parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from tickloom.operators.merge import INGEST_SEQ
from tickloom.operators.normalize import canonical_names
from tickloom.sources.raw import SOURCE_FILE, TRADING_DAY

#: Row number within its file, from 0.
POSITION = "position"
#: Bytes of text parsed at a time.
BLOCK = 4 << 20
#: Rows of a Parquet batch.
ROWS = 1 << 16

_ADDED = pa.schema([(SOURCE_FILE, pa.string()), (TRADING_DAY, pa.date32()), (POSITION, pa.int64())])
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


@dataclass
class DayFile(InputPartition):
    """One file of one trading day; a task reads one."""

    path: str
    day: date
    changed: int  # nanoseconds since 1970


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path: a URI names it, a plain path is local (or mounted)."""
    if "://" in path or path.startswith("file:"):
        uri = re.sub(r"^file:/+", "file:///", path)
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), path


class DayFiles(DataSource):
    """Options: ``path`` (the folder of the day files), ``ext`` (``csv.gz``, ``csv`` or ``parquet``),
    ``columns`` (header, comma-separated; read from the first file if absent), ``start`` and ``end``
    (ISO dates, inclusive), ``symbols`` (a JSON list), and for streams ``settle_seconds`` (a file is
    taken when it has not changed for so long; 60). Without an option nothing is left out.

    Columns are the bar columns that the header feeds, text as it stands in the file, then
    ``source_file``, ``trading_day`` and ``position``. Files without a date in their path are
    not seen; of a day in both layouts the primary one is read, as in ``raw.list_files``.
    """

    @classmethod
    def name(cls) -> str:
        return "day_files"

    @property
    def ext(self) -> str:
        return self.options.get("ext", "csv.gz")

    @property
    def days(self) -> tuple[date, date]:
        """First and last day asked for."""
        first, last = self.options.get("start"), self.options.get("end")
        return (date.fromisoformat(first) if first else date.min,
                date.fromisoformat(last) if last else date.max)

    @property
    def symbols(self) -> list[str] | None:
        """The symbols asked for, None for all."""
        return json.loads(self.options["symbols"]) if "symbols" in self.options else None

    def files(self) -> list[DayFile]:
        """Files of the days asked for, by day. Folders of other months and days are not listed."""
        first, last = self.days
        system, root = _opened(self.options["path"])
        found: list[tuple[int, DayFile]] = []
        folders = [root]
        while folders:
            for entry in system.get_file_info(fs.FileSelector(folders.pop(), allow_not_found=True)):
                below = entry.path[len(root):].lstrip("/")
                named = _DAY.findall(below)
                day = _as_day(named[-1]) if named else None
                if entry.base_name.startswith(("_", ".")):
                    continue
                if entry.type == fs.FileType.Directory:
                    if first <= day <= last if day else _may_hold(below, first, last):
                        folders.append(entry.path)
                elif entry.path.endswith(f".{self.ext}") and day and first <= day <= last:
                    found.append((_layout(below, day), DayFile(entry.path, day, entry.mtime_ns)))
        best: dict[date, int] = {}
        for layout, file in found:
            best[file.day] = min(layout, best.get(file.day, layout))
        kept = [file for layout, file in found if layout == best[file.day]]
        return sorted(kept, key=lambda f: (f.day, f.path))

    def header(self) -> pa.Schema:
        """Columns of the files: those of the first one, unless the option names them."""
        if self.options.get("columns"):
            return pa.schema([(c.strip(), pa.string()) for c in self.options["columns"].split(",")])
        files = self.files()
        if not files:
            raise FileNotFoundError(f"no day file below {self.options['path']}: give its columns")
        system, _ = _opened(self.options["path"])
        if self.ext == "parquet":
            return parquet.read_schema(files[0].path, filesystem=system)
        with system.open_input_stream(files[0].path, compression="detect") as stream:
            return pa.schema([(c, pa.string()) for c in _text(stream, None).schema.names])

    def schema(self) -> T.StructType:
        header = self.header()
        fields = [f.with_name(n) for f, n in zip(header, canonical_names(header.names), strict=True)]
        return from_arrow_schema(pa.schema([*fields, *_ADDED]))

    def batches(self, file: DayFile, columns: list[str]) -> Iterator[pa.RecordBatch]:
        """Batches of one file under its own names; ``columns`` are the bar columns in order."""
        system, _ = _opened(self.options["path"])
        if self.ext == "parquet":
            with parquet.ParquetFile(file.path, filesystem=system) as source:
                yield from source.iter_batches(ROWS)
            return
        with system.open_input_stream(file.path, compression="detect") as stream:
            source = _text(stream, columns)
            yield from source

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return DayFileReader(self, schema)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return DayFileStream(self, schema)


def _text(stream, columns: list[str] | None) -> csv.CSVStreamingReader:
    """Text cells as they stand: an empty one is null, nothing is taken for a number."""
    kinds = csv.ConvertOptions(
        column_types=None if columns is None else dict.fromkeys(columns, pa.string()),
        null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False,
    )
    return csv.open_csv(stream, read_options=csv.ReadOptions(block_size=BLOCK), convert_options=kinds)


def _as_day(text: str) -> date | None:
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def _may_hold(below: str, first: date, last: date) -> bool:
    """Whether a folder without a date may hold files asked for: one named by year, or by year
    and month, holds those of its days only; any other may."""
    if re.fullmatch(r"\d{4}(/\d{2})?", below) is None:
        return True
    low, high = first.isoformat().replace("-", "/"), last.isoformat().replace("-", "/")
    return low[: len(below)] <= below <= high[: len(below)]


def _layout(below: str, day: date) -> int:
    """0 ``YYYY/MM/day.ext``, 1 ``YYYY/MM/day/day.ext``, 2 any other."""
    at, named = f"/{day:%Y/%m}/", f"{day.isoformat()}."
    where = "/" + below
    return 1 if f"{at}{day.isoformat()}/{named}" in where else 0 if f"{at}{named}" in where else 2


def _rows(source: DayFiles, file: DayFile, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """One file in the columns of the source, rows of the symbols asked for."""
    target = to_arrow_schema(schema)
    asked = None if source.symbols is None else pa.array(source.symbols, pa.string())
    wanted = target.names[: -len(_ADDED)]
    text = source.header().names if source.ext != "parquet" else []
    at, checked = 0, False
    for batch in source.batches(file, text):
        names = canonical_names(batch.schema.names)
        if not checked and sorted(names) != sorted(wanted):
            raise ValueError(f"{file.path} has the columns {names}, expected {wanted}")
        checked = True
        cells = dict(zip(names, batch.columns, strict=True))
        n = batch.num_rows
        columns = [cells[c].cast(target.field(c).type) for c in wanted]
        columns += [pa.repeat(file.path, n), pa.repeat(pa.scalar(file.day, pa.date32()), n),
                    pa.array(range(at, at + n), pa.int64())]
        at += n
        out = pa.RecordBatch.from_arrays(columns, schema=target)
        if asked is not None:
            out = out.filter(pc.is_in(out.column("symbol"), asked))
        yield out


class DayFileReader(DataSourceReader):
    """Batch reads: one task a file."""

    def __init__(self, source: DayFiles, schema: T.StructType):
        self.source, self.schema = source, schema

    def partitions(self) -> list[DayFile]:
        return self.source.files()

    def read(self, partition: DayFile | None) -> Iterator[pa.RecordBatch]:
        if partition is not None:  # Spark reads an empty list of files as one partition
            yield from _rows(self.source, partition, self.schema)


class DayFileStream(DataSourceStreamReader):
    """Streams: the offset is the latest change of the files taken, in nanoseconds.

    A batch holds the files that changed after its start and up to its end, so a batch repeated
    after a failure reads the same files. A file that arrives with an older change than the last
    offset is not taken: write files in place or under their final name within the settle time.
    A file that is replaced is taken again; a merge keeps the bars it has.
    """

    def __init__(self, source: DayFiles, schema: T.StructType):
        self.source, self.schema = source, schema
        self.settle = int(float(source.options.get("settle_seconds", "60")) * 1e9)
        self.taken = 0

    def initialOffset(self) -> dict:
        return {"changed": 0}

    def latestOffset(self) -> dict:
        settled = time_ns() - self.settle
        changes = [f.changed for f in self.source.files()]
        self.taken = max([self.taken, *[c for c in changes if c <= settled]])
        return {"changed": self.taken}

    def partitions(self, start: dict, end: dict) -> list[DayFile]:
        files = self.source.files()
        return [f for f in files if start["changed"] < f.changed <= end["changed"]]

    def read(self, partition: DayFile) -> Iterator[pa.RecordBatch]:
        yield from _rows(self.source, partition, self.schema)


def read_day_files(
    spark: SparkSession,
    root: str,
    ext: str = "csv.gz",
    start: date | None = None,
    end: date | None = None,
    symbols: list[str] | None = None,
    provider: type[DayFiles] = DayFiles,
) -> DataFrame:
    """Raw rows of the day files of a folder with their file, day and input order, as
    ``raw.scan_files`` gives them."""
    spark.dataSource.register(provider)
    options = _options(root, ext, start, end, symbols)
    return _ordered(spark.read.format(provider.name()).options(**options).load())


def stream_day_files(
    spark: SparkSession,
    root: str,
    columns: list[str],
    ext: str = "csv.gz",
    start: date | None = None,
    end: date | None = None,
    symbols: list[str] | None = None,
    settle_seconds: float = 60,
    provider: type[DayFiles] = DayFiles,
) -> DataFrame:
    """The same as a stream; ``columns`` is the header, as there may be no file yet."""
    spark.dataSource.register(provider)
    options = _options(root, ext, start, end, symbols)
    options |= {"columns": ",".join(columns), "settle_seconds": str(settle_seconds)}
    return _ordered(spark.readStream.format(provider.name()).options(**options).load())


def _ordered(rows: DataFrame) -> DataFrame:
    """The row number as part of the input order by which the first of two bars stays."""
    order = F.struct(TRADING_DAY, SOURCE_FILE, POSITION)
    return rows.withColumn(INGEST_SEQ, order).drop(POSITION)


def _options(root, ext, start, end, symbols) -> dict[str, str]:
    given = {
        "path": root,
        "ext": ext,
        "start": start and start.isoformat(),
        "end": end and end.isoformat(),
        "symbols": None if symbols is None else json.dumps(symbols),
    }
    return {k: v for k, v in given.items() if v is not None}
