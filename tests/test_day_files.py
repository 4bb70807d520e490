"""The data source over day files, next to the scans that Spark has by itself."""

import gzip
import os
from datetime import date

import pyarrow as pa
import pyarrow.csv
import pyarrow.parquet
import pytest
from pyspark.sql import functions as F

from tickloom.operators.merge import BAR_KEY, drop_duplicates_keep_first
from tickloom.operators.normalize import normalize_bars
from tickloom.sources import raw
from tickloom.sources.day_files import DayFiles, read_day_files, stream_day_files

HEADER = ["ticker", "window_start", "open", "high", "low", "close", "volume", "transactions"]


def put(root, where, rows, day):
    """A day file of (symbol, minute, close) rows."""
    path = root / where
    path.parent.mkdir(parents=True, exist_ok=True)
    start = int(f"{(day - date(1970, 1, 1)).days * 86_400 + 15 * 3600}") * 10**9
    lines = [f"{s},{start + m * 60 * 10**9},{c},{c},{c},{c},10,1" for s, m, c in rows]
    text = "\n".join([",".join(HEADER), *lines, ""])
    path.write_bytes(gzip.compress(text.encode()) if where.endswith(".gz") else text.encode())
    return path


@pytest.fixture
def root(tmp_path):
    root = tmp_path / "minute_aggs"
    put(root, "2024/01/2024-01-02.csv.gz", [("A", 0, 1.5), ("NA", 0, 2.0), ("TRUE", 1, 3.0)], date(2024, 1, 2))
    put(root, "2024/01/2024-01-03/2024-01-03.csv.gz", [("A", 0, 9.0)], date(2024, 1, 3))
    put(root, "2024/01/2024-01-03.csv.gz", [("A", 0, 1.25), ("B", 2, 4.0)], date(2024, 1, 3))
    put(root, "2024/02/2024-02-01/2024-02-01.csv.gz", [("A", 0, 1.75)], date(2024, 2, 1))
    put(root, "2023/12/day=2023-12-29/part-0.csv.gz", [("B", 0, 5.0)], date(2023, 12, 29))
    put(root, "notes/readme.csv.gz", [("X", 0, 5.0)], date(2023, 12, 29))
    return root


def rows(df):
    return sorted(tuple(r) for r in df.select("symbol", F.col("close").cast("double"), "trading_day").collect())


def test_same_bars_as_the_scan(spark, root):
    paths = [r.path for r in raw.list_files(spark, str(root)).collect()]
    want = raw.bars_from_files(spark, paths)
    got = normalize_bars(read_day_files(spark, str(root)), per=raw.SOURCE_FILE)
    columns = ["timestamp", "symbol", "open", "close", "vwap", "volume", "n_trades", "trading_day"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    assert got.count() == 7


def test_days_and_symbols(spark, root):
    both = read_day_files(spark, str(root), start=date(2024, 1, 3), end=date(2024, 2, 1))
    assert rows(both) == [("A", 1.25, date(2024, 1, 3)), ("A", 1.75, date(2024, 2, 1)), ("B", 4.0, date(2024, 1, 3))]
    assert rows(read_day_files(spark, str(root), symbols=["NA", "TRUE"])) == [
        ("NA", 2.0, date(2024, 1, 2)), ("TRUE", 3.0, date(2024, 1, 2))]
    assert rows(read_day_files(spark, str(root), symbols=[])) == []


def test_one_frame_serves_several_conditions(spark, root):
    df = read_day_files(spark, str(root))
    late = df.where(F.col("trading_day") >= F.lit(date(2024, 1, 3)))
    assert (late.count(), df.count(), df.where("symbol = 'B'").count(), df.count()) == (3, 7, 2, 7)


def test_only_files_of_the_range_are_read(spark, root):
    put(root, "2024/03/2024-03-01.csv.gz", [], date(2024, 3, 1)).write_bytes(b"no gzip")
    df = read_day_files(spark, str(root), end=date(2024, 2, 28))
    assert df.rdd.getNumPartitions() == 4 and df.count() == 7


def test_positions_and_missing_cells(spark, tmp_path):
    path = put(tmp_path, "2024/01/2024-01-02.csv", [("A", m, m) for m in range(500)], date(2024, 1, 2))
    path.write_text(path.read_text() + "B,,1,1,1,1,,\n")
    got = read_day_files(spark, str(tmp_path), "csv")
    assert sorted(r.ingest_seq.position for r in got.collect()) == list(range(501))
    assert got.where("timestamp IS NULL").count() == 1


def test_another_header_fails(spark, root):
    other = root / "2024/01/2024-01-04.csv.gz"
    other.write_bytes(gzip.compress(b"ticker,window_start,close\nA,1,2\n"))
    with pytest.raises(Exception, match="columns"):
        read_day_files(spark, str(root)).collect()


def test_no_files(spark, tmp_path):
    with pytest.raises(Exception, match="no day file"):
        read_day_files(spark, str(tmp_path / "none")).schema  # noqa: B018


def test_parquet_keeps_its_types(spark, tmp_path):
    folder = tmp_path / "2024" / "01"
    folder.mkdir(parents=True)
    table = pa.table({"T": ["A", "B"], "t": [1704207600000, 1704207660000], "c": [1.1, None], "v": [3, 4]})
    pa.parquet.write_table(table, folder / "2024-01-02.parquet")
    got = read_day_files(spark, str(tmp_path), "parquet", symbols=["A"])
    assert dict(got.dtypes)["close"] == "double"
    bars = normalize_bars(got, per=raw.SOURCE_FILE).select(F.date_format("timestamp", "yyyy-MM-dd HH:mm"), "close")
    assert [tuple(r) for r in bars.collect()] == [("2024-01-02 15:00", 1.1)]


class Piped(DayFiles):
    """A provider whose files are separated by bars."""

    @classmethod
    def name(cls):
        return "piped_files"

    def batches(self, file, columns):
        options = pa.csv.ParseOptions(delimiter="|")
        kinds = pa.csv.ConvertOptions(column_types=dict.fromkeys(columns, pa.string()))
        yield from pa.csv.read_csv(file.path, parse_options=options, convert_options=kinds).to_batches()

    def header(self):
        return pa.schema([("ticker", pa.string()), ("window_start", pa.string()), ("close", pa.string())])


def test_a_provider_of_ones_own(spark, tmp_path):
    (tmp_path / "2024-01-02.psv").write_text("ticker|window_start|close\nA|1704207600|2.5\n")
    got = read_day_files(spark, str(tmp_path), "psv", provider=Piped)
    assert rows(got) == [("A", 2.5, date(2024, 1, 2))]


def test_the_first_bar_of_a_key_stays(spark, tmp_path):
    rows_of_day = [("A", 0, 1.0 + i) for i in range(50)]
    put(tmp_path, "day=2024-01-02/part-1.csv.gz", rows_of_day[25:], date(2024, 1, 2))
    put(tmp_path, "day=2024-01-02/part-0.csv.gz", rows_of_day[:25], date(2024, 1, 2))
    bars = normalize_bars(read_day_files(spark, str(tmp_path)), per=raw.SOURCE_FILE)
    kept = drop_duplicates_keep_first(bars.select("timestamp", "symbol", "close", "ingest_seq"), BAR_KEY)
    assert [r.close for r in kept.collect()] == [1.0]


def run(stream, out, checkpoint):
    query = (stream.writeStream.format("parquet").option("path", str(out))
             .option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start())
    query.awaitTermination()


def test_stream_takes_each_change_once(spark, root, tmp_path):
    out, offsets = tmp_path / "out", tmp_path / "offsets"

    def step():
        run(stream_day_files(spark, str(root), HEADER, settle_seconds=0), out, offsets)
        return spark.read.parquet(str(out)).count()

    assert step() == 7
    assert step() == 7  # nothing new
    put(root, "2024/01/2024-01-01.csv.gz", [("C", 0, 1.0)], date(2024, 1, 1))  # an older day, landed later
    assert step() == 8
    path = put(root, "2024/02/2024-02-01/2024-02-01.csv.gz", [("A", 0, 1.75), ("D", 0, 2.0)], date(2024, 2, 1))
    assert step() == 10  # replaced: both of its rows
    os.utime(path, ns=(2**62, 2**62))
    assert step() == 10  # not settled yet
