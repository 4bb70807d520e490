"""Random panels against a plain loop over a dense table."""

import random
from datetime import UTC, date, datetime, timedelta

import pytest

from tests.helpers import bars
from tickloom.operators import actions as act
from tickloom.operators.panel import adjusted_price_panel, price_panel
from tickloom.operators.sessions import trading_minutes

SYMBOLS = ["A", "B", "C", "D"]
START, END = datetime(2024, 1, 2, 15, 7, 30), datetime(2024, 1, 10, 16, 0)


def random_bars(rng, freq):
    stamps = []
    day = datetime(2024, 1, 1)
    while day < datetime(2024, 1, 12):
        if freq == "1d":
            stamps += [day + timedelta(hours=h) for h in ((5, 21) if day.day % 4 == 0 else (21,))]
        else:
            stamps += [day + timedelta(minutes=m) for m in range(860, 1290, 7)]
            stamps.append(day + timedelta(minutes=1000, seconds=20))
        day += timedelta(days=1)
    rows = {}
    for stamp in stamps:
        for symbol in SYMBOLS[:3]:
            # Symbol A holds most rows; the others are sparse.
            if rng.random() < (0.9 if symbol == "A" else 0.15):
                price = None if rng.random() < 0.1 else round(rng.uniform(5, 50), 2)
                rows[stamp, symbol] = (price, rng.randrange(1, 100))
    return rows


def naive_panel(rows, freq, minutes, field, fill):
    rows = {k: v[field] for k, v in rows.items() if START <= k[0] <= END}
    symbols = sorted({s for _, s in rows})
    grid = minutes if freq == "1min" else sorted({t for t, _ in rows})
    out = {}
    for s in symbols:
        last = None
        for t in grid:
            value = rows.get((t, s))
            if fill and field == 0:
                last = value if value is not None else last
                value = last
            elif fill:
                value = value or 0
            out[t, s] = value
    return out


def naive_adjusted(panel, splits, cash):
    days = sorted({t.date() for t, _ in panel})
    out = {}
    for s in {s for _, s in panel}:
        stamps = sorted(t for t, x in panel if x == s)
        daily = {d: None for d in days}
        for t in stamps:
            if panel[t, s] is not None:
                daily[t.date()] = panel[t, s]
        prior, held = {}, None
        for d in days:
            prior[d] = held if held is not None else daily[d]
            held = daily[d] if daily[d] is not None else held
        factor, sf, df = {}, 1.0, 1.0
        for d in reversed(days):
            factor[d] = (sf, df)
            ratio = splits.get((d, s), 1.0)
            sf *= ratio if ratio > 0 else 1.0
            paid = cash.get((d, s), 0.0)
            step = 1 - paid / prior[d] if prior[d] else 1.0
            if paid > 0 and not 0 < step <= 1:
                step = 1.0
            df *= step
        for t in stamps:
            value = panel[t, s]
            out[t, s] = None if value is None else value * factor[t.date()][0] * factor[t.date()][1]
    return out


def collected(df, field):
    epoch = datetime(1970, 1, 1)
    from pyspark.sql import functions as F

    rows = df.select(F.unix_micros("timestamp").alias("t"), "symbol", F.col(field).alias("v"))
    return {(epoch + timedelta(microseconds=r.t), r.symbol): r.v for r in rows.collect()}


@pytest.mark.parametrize("freq", ["1d", "1min"])
@pytest.mark.parametrize("seed", [1, 2])
def test_panels(spark, freq, seed):
    rng = random.Random(seed)
    rows = random_bars(rng, freq)
    df = bars(
        spark,
        [(str(t), s, p, p, p, p, p, v, 1) for (t, s), (p, v) in rows.items()],
    ).repartition(5)
    stamps = trading_minutes(spark, START, END).selectExpr("unix_micros(timestamp) AS t")
    minutes = sorted(
        datetime.fromtimestamp(r.t / 1e6, UTC).replace(tzinfo=None) for r in stamps.collect()
    )
    args = (freq, SYMBOLS, START, END)
    for name, field in (("close", 0), ("volume", 1)):
        for fill in (True, False):
            got = price_panel(df, *args, fields=[name], fill_missing_bars=fill)
            assert collected(got, name) == naive_panel(rows, freq, minutes, field, fill)

    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(12)]
    splits = {(rng.choice(days), s): rng.choice([0.5, 0.25, 3.0, -1.0]) for s in SYMBOLS * 2}
    cash = {(rng.choice(days), s): rng.choice([0.3, 1.7, -0.4, 900.0]) for s in SYMBOLS * 3}
    ratio_df = spark.createDataFrame(
        [(*k, v) for k, v in splits.items()], "date date, symbol string, split_ratio double"
    )
    cash_df = spark.createDataFrame(
        [(*k, v) for k, v in cash.items()], "date date, symbol string, cash_amount double"
    )
    want = naive_adjusted(naive_panel(rows, freq, minutes, 0, True), splits, cash)
    assert collected(adjusted_price_panel(df, ratio_df, cash_df, *args), "close") == want
    general = act.apply_price_adjustments(price_panel(df, *args), ratio_df, cash_df)
    assert collected(general, "close") == want
