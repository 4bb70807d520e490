"""The stream that ranks a day when it closes."""

import random

from pyspark.sql import functions as F

from tests.helpers import close_bars, table
from tickloom.operators.universe import build_universe
from tickloom.sinks import lake as sink
from tickloom.sources.lake import Lake, load_universe
from tickloom.streaming.universe import closed_days, stream_daily_universe

COLS = ("date", "symbol", "notional", "rank")


def minutes(spark, days, seed):
    rng = random.Random(seed)
    rows = [
        (f"2024-01-{d:02d} {h}:{m:02d}", s, float(rng.randrange(1, 50)), rng.randrange(1, 9))
        for d in days for s in "ABC" for h in (15, 16) for m in rng.sample(range(60), 5)
    ]
    return close_bars(spark, rows)


def test_days_are_ranked_when_closed_and_late_bars_left_out(spark, tmp_path):
    lake, offsets = Lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/offsets"
    early, later = minutes(spark, range(2, 6), 1), minutes(spark, range(8, 12), 2)
    late = close_bars(spark, [("2024-01-02 15:00", "LATE", 1.0)])

    def run():
        query = stream_daily_universe(lake, "1min", offsets, delay="1 day")
        query.awaitTermination()
        return query

    def ranked(bars, last):
        whole = build_universe(bars, F.to_date("timestamp"))
        return table(whole.where(F.day("date") <= last), *COLS)

    sink.write_bars(lake, early, "1min")
    run()
    # the last bar is of the 5th, after three in the afternoon: the 3rd ended over a day before
    assert table(load_universe(lake), *COLS) == ranked(early, 3)
    sink.write_bars(lake, later.union(late), "1min")
    query = run()
    assert table(load_universe(lake), *COLS) == ranked(early.union(later), 9)
    state = query.lastProgress.stateOperators if query.lastProgress else []
    held = sum(s.numRowsTotal for s in state)
    # of 241 bars the keys of twice the delay before the last one, and a row a symbol and open day
    assert 0 < held <= 3 * 30 + 9
    run()
    assert table(load_universe(lake), *COLS) == ranked(early.union(later), 9)


def test_a_bar_that_comes_twice_counts_once(spark, tmp_path):
    bars = minutes(spark, range(2, 4), 3)
    later = close_bars(spark, [("2024-01-20 15:00", "Z", 1.0)])
    for i, part in enumerate((bars, bars.limit(7), later)):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(bars.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    query = closed_days(stream, "1 day").writeStream.format("memory").queryName("closed").outputMode("append")
    query.option("checkpointLocation", f"{tmp_path}/offsets").trigger(availableNow=True).start().awaitTermination()
    want = build_universe(bars, F.to_date("timestamp"))
    assert table(spark.table("closed"), *COLS[:3]) == table(want, *COLS[:3])
