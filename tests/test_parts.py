"""Action tables rebuilt in parts and switched at once; panels as arrays."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import ts
from tickloom.operators import actions, panel
from tickloom.plans import jobs
from tickloom.sinks import lake as sink
from tickloom.sources import lake as src
from tickloom.sources import parts, raw
from tickloom.sources.lake import Lake


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path))


def splits(spark, *rows):
    return spark.createDataFrame(
        [(s, d, 1.0, to) for s, d, to in rows],
        "symbol string, execution_date string, split_from double, split_to double",
    )


def ratios(lake):
    return sorted(tuple(r) for r in src.load_split_ratio_table(lake).collect())


def whole(lake, end=None):
    return sorted(tuple(r) for r in actions.build_split_ratios(src.load_splits(lake), None, end).collect())


def test_a_build_writes_only_partitions_of_new_events(spark, lake):
    first = [(f"S{i:03d}", "2024-01-02", 2.0) for i in range(300)]
    sink.write_splits(lake, splits(spark, *first))
    sink.build_split_ratio_table(lake)
    before = parts.latest_state(lake, "split_ratios")
    assert len(before.folders) == 63 or len(before.folders) == 64
    sink.write_splits(lake, splits(spark, ("S007", "2024-02-01", 4.0), ("S007", "2024-01-02", 9.0)))
    sink.build_split_ratio_table(lake)
    after = parts.latest_state(lake, "split_ratios")
    assert sum(after.folders[p] != before.folders[p] for p in before.folders) == 1
    assert ratios(lake) == whole(lake) and len(ratios(lake)) == 301
    assert (date(2024, 1, 2), "S007", 0.5) in ratios(lake)
    sink.build_split_ratio_table(lake)
    assert parts.latest_state(lake, "split_ratios") == after and len(parts.states(lake, "split_ratios")) == 2


def test_only_events_of_touched_symbols_are_read(spark, lake):
    sink.write_splits(lake, splits(spark, ("A", "2024-01-02", 2.0), ("B", "2024-01-02", 2.0)))
    touched = spark.createDataFrame([("A", date(2024, 1, 2))], "symbol string, date date")
    events = sink._of_keys(src.load_splits(lake), touched, "execution_date")
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,A)" in plan or "In(symbol, [A])" in plan
    assert [r.symbol for r in events.collect()] == ["A"]


def test_dates_move_a_build(spark, lake):
    rows = [("A", "2024-01-02", 2.0), ("A", "2024-01-20", 3.0), ("B", "2024-03-01", 5.0)]
    sink.write_splits(lake, splits(spark, *rows))
    for end in (date(2024, 1, 10), date(2024, 1, 31), None, date(2024, 1, 10)):
        sink.build_split_ratio_table(lake, end=end)
        assert ratios(lake) == whole(lake, end)
    sink.build_split_ratio_table(lake, date(2024, 1, 15))
    assert [r[0] for r in ratios(lake)] == [date(2024, 1, 20), date(2024, 3, 1)]


def test_corrected_events_reach_the_table(spark, lake):
    sink.write_splits(lake, splits(spark, ("A", "2024-01-02", 2.0), ("B", "2024-01-02", 2.0)))
    sink.build_split_ratio_table(lake)
    for to in (4.0, 5.0):
        sink.write_splits(lake, splits(spark, ("A", "2024-01-02", to)), "upsert", datetime(2024, 1, 1 + int(to)))
        sink.build_split_ratio_table(lake)
        assert ratios(lake) == whole(lake) == [(date(2024, 1, 2), "A", 1 / to), (date(2024, 1, 2), "B", 0.5)]


def test_many_symbols_give_the_same_as_few(spark, lake, monkeypatch):
    sink.write_splits(lake, splits(spark, *[(f"S{i}", "2024-01-02", 2.0) for i in range(9)]))
    sink.build_split_ratio_table(lake)
    monkeypatch.setattr(sink, "NAMED", 3)
    sink.write_splits(lake, splits(spark, *[(f"S{i}", "2024-01-03", 4.0) for i in range(9)]))
    sink.build_split_ratio_table(lake)
    assert ratios(lake) == whole(lake) and len(ratios(lake)) == 18


def test_a_reader_sees_the_table_before_or_after_a_build(spark, lake, monkeypatch):
    sink.write_splits(lake, splits(spark, ("A", "2024-01-02", 2.0)))
    sink.build_split_ratio_table(lake)
    held = src.load_split_ratio_table(lake)
    seen, publish = [], parts.publish
    monkeypatch.setattr(parts, "publish", lambda *a: (seen.append(ratios(lake)), publish(*a)))
    sink.write_splits(lake, splits(spark, ("A", "2024-01-03", 4.0)))
    sink.build_split_ratio_table(lake)
    assert seen == [[(date(2024, 1, 2), "A", 0.5)]] and len(ratios(lake)) == 2
    assert held.count() == 1  # looked up before the build


def test_a_build_that_dies_leaves_the_table(spark, lake, monkeypatch):
    sink.write_splits(lake, splits(spark, ("A", "2024-01-02", 2.0)))
    sink.build_split_ratio_table(lake)
    sink.write_splits(lake, splits(spark, ("A", "2024-01-03", 4.0)))

    def die(*_):
        raise RuntimeError("gone")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="gone"):
        m.setattr(parts, "publish", die)
        sink.build_split_ratio_table(lake)
    assert len(ratios(lake)) == 1
    sink.build_split_ratio_table(lake)
    assert ratios(lake) == whole(lake) and len(ratios(lake)) == 2


def test_old_builds_are_removed(spark, lake):
    for i in range(5):
        sink.write_splits(lake, splits(spark, ("A", f"2024-01-0{i + 2}", 2.0)))
        path = sink.build_split_ratio_table(lake)
    assert len(parts.states(lake, "split_ratios")) == 2
    held = [f for f in os.listdir(path) if f.startswith("rows-") and any("part=" in p for p in os.listdir(f"{path}/{f}"))]
    assert len(held) == 2 and len(ratios(lake)) == 5


def test_a_failure_that_is_not_of_the_files_is_raised_at_once(lake, monkeypatch):
    days = [date(2024, 1, d) for d in (2, 3, 4, 5)]
    tries = []

    def full(*_, **__):
        tries.append(1)
        raise OSError("no space left")

    monkeypatch.setattr(jobs, "ingest", full)
    monkeypatch.setattr(jobs.raw, "bars_from_files", lambda spark, paths, **_: spark.createDataFrame(
        [(ts("2024-01-02"), "A")], "timestamp timestamp, symbol string"))
    monkeypatch.setattr(jobs.sink, "unique_bars", lambda bars: bars)
    with pytest.raises(OSError, match="no space"):
        jobs._ingest_files(lake, [(d, f"{d}.csv") for d in days], "1d", None, False)
    assert len(tries) == 1


def long(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp, symbol string, close double, volume double")


def test_a_matrix_has_a_value_per_slot(spark):
    a, b = datetime(2024, 1, 2), datetime(2024, 1, 3)
    rows = long(spark, [(a, "C", 3.0, 1.0), (a, "A", 1.0, None), (b, "B", 2.0, 5.0), (b, "X", 9.0, 9.0)])
    slots = panel.symbol_dictionary(rows.where("symbol <> 'X'"))
    assert [tuple(r) for r in slots.orderBy("slot").collect()] == [(0, "A", 3), (1, "B", 3), (2, "C", 3)]
    matrix = panel.to_matrix(rows, slots)
    assert [tuple(r)[1:] for r in matrix.orderBy("timestamp").collect()] == [
        ([1.0, None, 3.0], [None, None, 1.0]), ([None, 2.0, None], [None, 5.0, None])]
    back = panel.from_matrix(matrix, slots).where("close is not null").select(*rows.columns)
    assert back.exceptAll(rows.where("symbol <> 'X'")).count() == 0 and back.count() == 3


def test_a_symbol_that_comes_twice_fails(spark):
    rows = long(spark, [(datetime(2024, 1, 2), "A", 3.0, 1.0)] * 2)
    with pytest.raises(Exception, match="comes twice"):
        panel.to_matrix(rows, panel.symbol_dictionary(rows)).collect()


def test_an_empty_panel_gives_an_empty_matrix(spark):
    rows = long(spark, [])
    slots = panel.symbol_dictionary(rows)
    assert panel.from_matrix(panel.to_matrix(rows, slots), slots).count() == 0


def test_a_matrix_of_50_000_symbols(spark):
    n = 50_000
    rows = spark.range(3 * n).where("id % 7 <> 3").select(
        F.timestamp_seconds(F.col("id") % 3).alias("timestamp"),
        F.format_string("S%06d", F.floor(F.col("id") / 3)).alias("symbol"),
        F.col("id").cast("double").alias("close"),
    )
    slots = panel.symbol_dictionary(spark.range(n).select(F.format_string("S%06d", "id").alias("symbol")))
    matrix = panel.to_matrix(rows, slots)
    got = {r[0].second: r[1] for r in matrix.collect()}
    for k in range(3):
        assert got[k] == [None if (3 * i + k) % 7 == 3 else float(3 * i + k) for i in range(n)]


def test_a_window_lists_its_own_folders(spark, lake, monkeypatch):
    root = f"{lake.root}/raw"
    names = ["2022/12/2022-12-30", "2023/12/2023-12-29", "2024/01/2024-01-02", "2024/01/2024-01-03/2024-01-03",
             "2024/02/2024-02-01", "2024/notes/2024-01-05", "date=2024-01-04/part-0", "date=2024-03-01/part-0",
             "2024-01-08", "more/2024-01-09"]
    for name in names:
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}.csv.gz", "w") as out:
            out.write("x")
    listed = []
    monkeypatch.setattr(raw, "children", lambda s, p, f=raw.children: (listed.append(p), f(s, p))[1])
    first, last = date(2024, 1, 1), date(2024, 1, 31)
    found = [f.removeprefix(root + "/") for f in raw.window_folders(spark, root, first, last)]
    assert sorted(found) == ["2024-01-08.csv.gz", "2024/01", "2024/notes", "date=2024-01-04", "more"]
    assert listed == [root, f"{root}/2024"]
    whole = raw.list_files(spark, root).where(F.col("date").between(first, last))
    window = raw.list_files(spark, root, start=first, end=last)
    assert sorted(window.collect()) == sorted(whole.collect()) and window.count() == 6
    assert raw.list_files(spark, root, start=date(2020, 1, 1), end=date(2020, 2, 1)).count() == 0
    assert raw.list_files(spark, f"{root}/none", start=first, end=last).count() == 0
    across = raw.list_files(spark, root, start=date(2022, 12, 1), end=date(2024, 1, 2))
    assert across.count() == 3
