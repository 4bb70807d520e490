"""The same answers as plain SQL for DuckDB, on the same test tables."""

from __future__ import annotations

# NYSE closures (weekends excluded by rule) in the years the data covers.
HOLIDAYS = {
    1995: "01-02 02-20 04-14 05-29 07-04 09-04 11-23 12-25",
    1996: "01-01 02-19 04-05 05-27 07-04 09-02 11-28 12-25",
    1997: "01-01 02-17 03-28 05-26 07-04 09-01 11-27 12-25",
    1998: "01-01 01-19 02-16 04-10 05-25 07-03 09-07 11-26 12-25",
    1999: "01-01 01-18 02-15 04-02 05-31 07-05 09-06 11-25 12-24",
    2000: "01-17 02-21 04-21 05-29 07-04 09-04 11-23 12-25",
    2001: "01-01 01-15 02-19 04-13 05-28 07-04 09-03 09-11 09-12 09-13 09-14 11-22 12-25",
    2023: "12-25",
    2024: "01-01 01-15 02-19 03-29 05-27 06-19 07-04 09-02 11-28 12-25",
}

# 13:00 closes in 1995-2001.
EARLY_CLOSES = (
    "1995-07-03 1995-11-24 1996-07-05 1996-11-29 1996-12-24 1997-07-03 1997-11-28 "
    "1997-12-24 1997-12-26 1998-11-27 1998-12-24 1999-11-26 1999-12-31 2000-07-03 "
    "2000-11-24 2001-07-03 2001-11-23 2001-12-24"
).split()


def _dates(items) -> str:
    return ", ".join(f"(DATE '{d}')" for d in items)


_HOLIDAY_ROWS = _dates(f"{y}-{d}" for y, days in HOLIDAYS.items() for d in days.split())

SESSIONS = f"""
holidays(d) AS (VALUES {_HOLIDAY_ROWS}),
early(d) AS (VALUES {_dates(EARLY_CLOSES)}),
sessions AS (
  SELECT CAST(g AS DATE) AS date
  FROM (SELECT unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2024-03-01',
                                      INTERVAL 1 DAY)) AS g)
  WHERE isodow(g) < 6 AND CAST(g AS DATE) NOT IN (SELECT d FROM holidays)
)"""

BARS_1D = """
bars_1d AS (
  SELECT l_shipdate AS timestamp, concat('S', CAST(l_suppkey % 10 AS VARCHAR)) AS symbol,
    min_by(l_extendedprice / l_quantity,
      ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS open,
    max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
    max_by(l_extendedprice / l_quantity,
      ROW(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)) AS close,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
      / CAST(sum(l_quantity) AS DOUBLE) AS vwap,
    CAST(sum(l_quantity) AS BIGINT) AS volume, count(*) AS n_trades
  FROM lineitem GROUP BY l_shipdate, l_suppkey % 10
)"""


def _event_bars(name: str, unit: str) -> str:
    return f"""
{name} AS (
  SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS timestamp, event_type AS symbol,
    min_by(value, ROW(ts, event_id)) AS open, max(value) AS high, min(value) AS low,
    max_by(value, ROW(ts, event_id)) AS close,
    CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS vwap,
    CAST(sum(1 + user_id % 7) AS BIGINT) AS volume, count(*) AS n_trades
  FROM events GROUP BY date_trunc('{unit}', ts), event_type
)"""


BARS_1MIN = _event_bars("bars_1min", "minute")
BARS_EVENT_DAYS = _event_bars("bars_day", "day")

SPLITS = """
splits AS (
  SELECT o_orderkey AS event_id, concat('S', CAST(o_custkey % 10 AS VARCHAR)) AS symbol,
    CAST(o_orderdate AS DATE) AS date,
    pow(2, o_orderkey % 3) AS split_from, pow(2, (o_orderkey // 3) % 3) AS split_to
  FROM orders
),
ratios AS (
  SELECT date, symbol, product(split_from / split_to) AS split_ratio
  FROM splits GROUP BY date, symbol
)"""

DIVIDENDS = """
dividends AS (
  SELECT o_orderkey AS event_id, concat('S', CAST(o_custkey % 10 AS VARCHAR)) AS symbol,
    CAST(o_orderdate AS DATE) AS date,
    CAST(o_orderkey % 41 / 4.0 AS DOUBLE) AS cash_amount
  FROM orders
),
cash AS (
  SELECT date, symbol, sum(cash_amount) AS cash_amount
  FROM dividends WHERE cash_amount <> 0 GROUP BY date, symbol
)"""

DIRTY_DIVIDENDS = f"""{DIVIDENDS},
dirty AS (
  SELECT symbol, date,
    CASE WHEN event_id % 121 = 0 THEN 1000000000.0
         WHEN event_id % 77 = 0 THEN -cash_amount
         WHEN event_id % 55 = 0 THEN NULL ELSE cash_amount END AS cash_amount
  FROM dividends
),
dirty_cash AS (
  SELECT date, symbol, sum(cash_amount) AS cash_amount
  FROM dirty WHERE cash_amount <> 0 GROUP BY date, symbol
)"""

_MINUTE_EVENT = """
  SELECT s_suppkey,
    CASE s_suppkey % 5 WHEN 0 THEN 'click' WHEN 1 THEN 'error' WHEN 2 THEN 'purchase'
      WHEN 3 THEN 'signup' ELSE 'view' END AS symbol,
    DATE '2024-01-01' + CAST(s_suppkey * 7 % 30 AS INTEGER) AS date
  FROM supplier"""

MINUTE_ACTIONS = f"""
minute_event AS ({_MINUTE_EVENT}),
ratios AS (
  SELECT date, symbol,
    product(pow(2, s_suppkey % 3) / pow(2, (s_suppkey // 3) % 3)) AS split_ratio
  FROM minute_event GROUP BY date, symbol
),
cash AS (
  SELECT date, symbol, sum(s_suppkey % 9 / 4.0) AS cash_amount
  FROM minute_event WHERE s_suppkey % 9 <> 0 GROUP BY date, symbol
)"""

_UPTO = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _filled(field: str) -> str:
    return (
        f"last_value({field} IGNORE NULLS) OVER "
        f"(PARTITION BY symbol ORDER BY timestamp {_UPTO}) AS {field}"
    )


def _zeroed(field: str) -> str:
    return f"coalesce({field}, 0) AS {field}"


GRID_1D = """
grid AS (
  SELECT t.timestamp, s.symbol FROM (SELECT DISTINCT timestamp FROM bars_1d) t
  CROSS JOIN (SELECT DISTINCT symbol FROM bars_1d) s
),
dense AS (SELECT * FROM grid LEFT JOIN bars_1d USING (timestamp, symbol))"""

GRID_1MIN = f"""{SESSIONS},
minutes AS (
  SELECT unnest(generate_series(CAST(date AS TIMESTAMP) + INTERVAL 870 MINUTE,
    CAST(date AS TIMESTAMP) + INTERVAL 1259 MINUTE, INTERVAL 1 MINUTE)) AS timestamp
  FROM sessions WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
),
grid AS (
  SELECT m.timestamp, s.symbol FROM minutes m
  CROSS JOIN (SELECT DISTINCT symbol FROM bars_1min) s
),
dense AS (SELECT * FROM grid LEFT JOIN bars_1min USING (timestamp, symbol))"""


def _daily(*selected: str) -> str:
    return f"WITH {BARS_1D},{GRID_1D} SELECT timestamp, symbol, {', '.join(selected)} FROM dense"


def _minutes(*selected: str) -> str:
    return (
        f"WITH {BARS_1MIN},{GRID_1MIN} "
        f"SELECT timestamp, symbol, {', '.join(selected)} FROM dense"
    )


# Day rows ``days(symbol, date, px, split_ratio, cash_amount)`` to both factors. DuckDB's
# windowed product multiplies in tree order, so the product of the later dates is folded
# latest first over a list instead: the last digits then do not depend on the engine.
FACTORS = f"""
prior AS (
  SELECT *, coalesce(last_value(px IGNORE NULLS) OVER
    (PARTITION BY symbol ORDER BY date {_BEFORE}), px) AS prior_close FROM days
),
steps AS (
  SELECT *, CASE WHEN split_ratio > 0 THEN split_ratio ELSE 1.0 END AS split_step,
    CASE WHEN prior_close <> 0
      THEN 1.0 - coalesce(cash_amount, 0.0) / prior_close ELSE 1.0 END AS raw_step
  FROM prior
),
clean AS (
  SELECT *, CASE WHEN raw_step IS NULL THEN 1.0
    WHEN cash_amount > 0 AND (raw_step <= 0 OR raw_step > 1) THEN 1.0
    ELSE raw_step END AS dividend_step FROM steps
),
moves AS (
  SELECT symbol, list(date ORDER BY date DESC) AS dates,
    list(split_step ORDER BY date DESC) AS splits,
    list(dividend_step ORDER BY date DESC) AS dividends
  FROM clean WHERE split_step <> 1 OR dividend_step <> 1 GROUP BY symbol
),
counted AS (
  SELECT c.*, splits, dividends,
    coalesce(len(list_filter(dates, lambda d: d > c.date)), 0) AS later
  FROM clean c LEFT JOIN moves m ON m.symbol = c.symbol
),
factors AS (
  SELECT symbol, date, cash_amount, split_ratio, raw_step,
    list_reduce(list_prepend(1.0, splits[1:later]), lambda a, b: a * b) AS split_factor,
    list_reduce(list_prepend(1.0, dividends[1:later]), lambda a, b: a * b) AS dividend_factor
  FROM counted
)"""


def _dense_days(field: str) -> str:
    """Day rows of the filled dense panel ``filled(timestamp, symbol, <field>)``."""
    return f"""
days AS (
  SELECT p.symbol, p.date, p.px, r.split_ratio, c.cash_amount
  FROM (SELECT symbol, CAST(timestamp AS DATE) AS date,
          max_by({field}, timestamp) FILTER (WHERE {field} IS NOT NULL) AS px
        FROM filled GROUP BY symbol, CAST(timestamp AS DATE)) p
  LEFT JOIN ratios r ON r.symbol = p.symbol AND r.date = p.date
  LEFT JOIN cash c ON c.symbol = p.symbol AND c.date = p.date
)"""


def _adjusted(ctes: list[str], field: str, fill: str, value: str) -> str:
    parts = [
        *ctes,
        f"filled AS (SELECT timestamp, symbol, {fill} FROM dense)",
        _dense_days(field),
        FACTORS,
    ]
    return f"""WITH {','.join(parts)}
SELECT f.timestamp, f.symbol, {value} AS {field} FROM filled f
JOIN factors x ON x.symbol = f.symbol AND x.date = CAST(f.timestamp AS DATE)"""


# Day rows of an undense panel: events on panel dates count even where the symbol lacks a row.
def _sparse_days(cash: str, ratio: str = "split_ratio") -> str:
    return f"""
px_days AS (SELECT symbol, CAST(timestamp AS DATE) AS date, close AS px FROM bars_1d),
on_panel AS (
  SELECT date, symbol FROM px_days
  UNION SELECT date, symbol FROM ratios WHERE date IN (SELECT date FROM px_days)
  UNION SELECT date, symbol FROM {cash} WHERE date IN (SELECT date FROM px_days)
),
days AS (
  SELECT k.symbol, k.date, p.px, {ratio} AS split_ratio, c.cash_amount FROM on_panel k
  LEFT JOIN px_days p ON p.symbol = k.symbol AND p.date = k.date
  LEFT JOIN ratios r ON r.symbol = k.symbol AND r.date = k.date
  LEFT JOIN {cash} c ON c.symbol = k.symbol AND c.date = k.date
)"""


def _sparse(dividends: str, cash: str, value: str, name: str) -> str:
    return f"""WITH {BARS_1D},{SPLITS},{dividends},{_sparse_days(cash)},{FACTORS}
SELECT b.timestamp, b.symbol, {value} AS {name} FROM bars_1d b
JOIN factors x ON x.symbol = b.symbol AND x.date = CAST(b.timestamp AS DATE)"""


_PRICE = "f.close * x.split_factor * x.dividend_factor"
_VOLUME = "f.volume / x.split_factor"

LEDGER = """
ledger AS (
  SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS date,
    CASE WHEN o_orderkey % 2 = 0 THEN '1d' ELSE '1min' END AS freq,
    CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'started'
      ELSE 'failed' END AS status
  FROM orders
)"""

ORDER_DATES = "order_dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders)"

UNIVERSE = f"""{BARS_1MIN},
notional AS (
  SELECT CAST(timestamp AS DATE) AS date, symbol,
    max_by(close, timestamp) * CAST(sum(volume) AS DOUBLE) AS notional
  FROM bars_1min GROUP BY CAST(timestamp AS DATE), symbol
),
universe AS (
  SELECT date, symbol, notional,
    CAST(row_number() OVER (PARTITION BY date ORDER BY notional DESC, symbol) AS BIGINT) AS rank
  FROM notional
)"""

_SESSION_BARS = f"""WITH {BARS_1MIN},{SESSIONS}
SELECT timestamp, symbol, open, high, low, close, close AS vwap,
  CAST(volume AS DOUBLE) AS volume, n_trades
FROM bars_1min WHERE CAST(timestamp AS DATE) IN (SELECT date FROM sessions)"""


_SNAPSHOTS = f"""WITH {BARS_EVENT_DAYS},{SESSIONS}
SELECT CAST(timestamp AS DATE) AS date, symbol, close * CAST(volume AS DOUBLE) AS notional,
  CAST(row_number() OVER (PARTITION BY CAST(timestamp AS DATE)
    ORDER BY close * CAST(volume AS DOUBLE) DESC, symbol) AS BIGINT) AS rank
FROM bars_day WHERE CAST(timestamp AS DATE) IN (SELECT date FROM sessions)"""

# Events of the minute symbols that two updates take in: the days between them are in neither.
_SYNCED = """
events_of AS (
  SELECT * FROM (
    SELECT ['click', 'error', 'purchase', 'signup', 'view'][s_suppkey % 5 + 1] AS symbol,
      CAST(DATE '2024-01-01' + CAST(s_suppkey * 7 % 30 AS INTEGER) AS DATE) AS day,
      pow(2, s_suppkey % 3) AS split_from, pow(2, (s_suppkey // 3) % 3) AS split_to,
      CAST(s_suppkey % 9 / 4.0 AS DOUBLE) AS cash
    FROM supplier
  ) WHERE day NOT BETWEEN DATE '2024-01-13' AND DATE '2024-01-15'
)"""


def _neighbour(agg: str, compare: str, name: str) -> str:
    return f"""WITH {SESSIONS},{ORDER_DATES}
SELECT o.date, {agg}(s.date) AS {name} FROM order_dates o
JOIN sessions s ON s.date {compare} o.date
  AND s.date BETWEEN o.date - 15 AND o.date + 15 GROUP BY o.date"""


def _wide(field: str, prefix: str = "") -> str:
    return ", ".join(
        f"max(CASE WHEN symbol = 'S{i}' THEN {field} END) AS {prefix}S{i}" for i in range(10)
    )


ORACLES: dict[str, str] = {
    "adjusted_close_panel": _adjusted(
        [BARS_1D, GRID_1D, SPLITS, DIVIDENDS], "close", _filled("close"), _PRICE
    ),
    "adjusted_volume_panel": _adjusted(
        [BARS_1D, GRID_1D, SPLITS, DIVIDENDS], "volume", _zeroed("volume"), _VOLUME
    ),
    "panel_long_1d": _daily(
        _filled("open"), _filled("close"), _filled("vwap"),
        "CAST(coalesce(volume, 0) AS DOUBLE) AS volume",
    ),
    "panel_long_1d_unfilled": _daily("close"),
    "panel_long_1min": _minutes(_filled("close")),
    "panel_long_1min_fields": _minutes(
        *[_filled(f) for f in ("open", "high", "low", "close")],
        "CAST(coalesce(volume, 0) AS DOUBLE) AS volume",
        "CAST(coalesce(n_trades, 0) AS DOUBLE) AS n_trades",
    ),
    "panel_long_1min_unfilled": _minutes("volume"),
    "adjusted_close_panel_1min": _adjusted(
        [BARS_1MIN, GRID_1MIN, MINUTE_ACTIONS], "close", _filled("close"), _PRICE
    ),
    "adjusted_volume_panel_1min": _adjusted(
        [BARS_1MIN, GRID_1MIN, MINUTE_ACTIONS], "volume", _zeroed("volume"), _VOLUME
    ),
    "panel_wide_close": f"""WITH filled AS ({_daily(_filled("close"))})
SELECT timestamp, {_wide("close")} FROM filled GROUP BY timestamp""",
    "panel_wide_multi": f"""WITH filled AS ({_daily(
        _filled("close"), "CAST(coalesce(volume, 0) AS DOUBLE) AS volume")})
SELECT timestamp, {_wide("close", "close_")}, {_wide("volume", "volume_")}
FROM filled GROUP BY timestamp""",
    "panel_matrix_close": f"""WITH filled AS ({_daily(_filled("close"))})
SELECT timestamp, symbol, CAST(dense_rank() OVER (ORDER BY symbol) - 1 AS INTEGER) AS slot, close
FROM filled""",
    "split_ratio_table": f"""WITH {SPLITS}
SELECT date, symbol, product(split_from / split_to) AS split_ratio FROM splits
WHERE event_id % 74 <> 0 AND event_id % 111 <> 0 GROUP BY date, symbol""",
    "cash_dividend_table": f"WITH {DIVIDENDS} SELECT date, symbol, cash_amount FROM cash",
    "action_table_filter": f"""WITH {DIVIDENDS}
SELECT date, symbol, cash_amount FROM cash
WHERE date BETWEEN DATE '1996-03-01' AND DATE '2000-02-29'
  AND symbol IN ('S7', 'S1', 'nobody')""",
    "split_factors": _sparse(DIVIDENDS, "cash", "x.split_factor", "split_factor"),
    "dividend_factors": _sparse(DIVIDENDS, "cash", "x.dividend_factor", "dividend_factor"),
    "price_adjustments": _sparse(
        DIRTY_DIVIDENDS, "dirty_cash", "b.close * x.split_factor * x.dividend_factor", "close"
    ),
    "volume_adjustments": _sparse(DIVIDENDS, "cash", "b.volume / x.split_factor", "volume"),
    "invalid_action_counts": f"""WITH {BARS_1D},{SPLITS},{DIRTY_DIVIDENDS},{_sparse_days(
        "dirty_cash", "CASE WHEN day(r.date) = 1 THEN -r.split_ratio ELSE r.split_ratio END"
    )},{FACTORS}
SELECT CAST(count_if(split_ratio <= 0) AS BIGINT) AS invalid_splits,
  CAST(count_if(cash_amount < 0) AS BIGINT) AS negative_dividends,
  CAST(count_if(cash_amount > 0 AND (raw_step <= 0 OR raw_step > 1)) AS BIGINT)
    AS invalid_dividends
FROM factors""",
    "daily_close_from_minutes": f"""WITH {BARS_1MIN}
SELECT symbol, CAST(timestamp AS DATE) AS date,
  max_by(close, timestamp) FILTER (WHERE close IS NOT NULL) AS px
FROM bars_1min GROUP BY symbol, CAST(timestamp AS DATE)""",
    "raw_bars_normalised": f"""WITH {BARS_1D}
SELECT symbol, timestamp, open, high, low, close, CAST(volume AS DOUBLE) AS volume, n_trades,
  close AS vwap FROM bars_1d""",
    "symbol_filter": f"""WITH {BARS_1MIN}
SELECT timestamp, symbol, close FROM bars_1min WHERE symbol IN ('view', 'error')""",
    "reference_records": """SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS symbol,
  s_name AS name, n_name AS exchange,
  CASE WHEN s_suppkey % 3 = 0 THEN 'ETF' ELSE 'CS' END AS type, s_acctbal >= 0 AS is_active,
  CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS industry
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "reference_events": f"""WITH {DIVIDENDS}
SELECT event_id, symbol, CAST(date AS VARCHAR) AS ex_dividend_date, cash_amount FROM dividends
WHERE event_id % 13 <> 0 AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""",
    "bars_dedup": """SELECT timestamp, symbol, close, volume FROM (
  SELECT l_shipdate AS timestamp, concat('S', CAST(l_suppkey % 10 AS VARCHAR)) AS symbol,
    l_extendedprice AS close, l_quantity AS volume,
    row_number() OVER (PARTITION BY l_shipdate, l_suppkey % 10 ORDER BY l_orderkey,
      l_linenumber, l_partkey, l_quantity, l_extendedprice) AS n
  FROM lineitem) WHERE n = 1""",
    "bars_merge_keep_existing": f"""WITH {BARS_1D},
existing AS (SELECT timestamp, symbol, close, volume FROM bars_1d WHERE year(timestamp) <= 1999)
SELECT timestamp, symbol, close, volume, CAST(NULL AS INTEGER) AS revision FROM existing
UNION ALL
SELECT timestamp, symbol, close * 2, NULL, 1 FROM bars_1d b WHERE year(timestamp) >= 1997
  AND NOT EXISTS (SELECT 1 FROM existing e
    WHERE e.timestamp = b.timestamp AND e.symbol = b.symbol)""",
    "universe_snapshot": f"WITH {UNIVERSE} SELECT * FROM universe",
    "universe_top_n": f"WITH {UNIVERSE} SELECT * FROM universe WHERE rank <= 2",
    "universe_wide_market": """WITH notional AS (
  SELECT CAST(l_shipdate AS DATE) AS date, CAST(l_partkey AS VARCHAR) AS symbol,
    sum(l_quantity) AS notional
  FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_partkey)
SELECT date, symbol, notional,
  CAST(row_number() OVER (PARTITION BY date ORDER BY notional DESC, symbol) AS BIGINT) AS rank
FROM notional""",
    "sessions_in_range": f"""WITH {SESSIONS}
SELECT s.date, CAST(count(o_orderkey) AS BIGINT) AS n_orders
FROM sessions s LEFT JOIN orders ON CAST(o_orderdate AS DATE) = s.date
WHERE s.date BETWEEN (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)
  AND (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) GROUP BY s.date""",
    "is_session": f"""WITH {SESSIONS}
SELECT CAST(o_orderdate AS DATE) AS date,
  CAST(o_orderdate AS DATE) IN (SELECT date FROM sessions) AS is_session,
  CAST(count(*) AS BIGINT) AS n_orders FROM orders GROUP BY CAST(o_orderdate AS DATE)""",
    # US daylight saving time in 1987-2006: first Sunday of April to last Sunday of October.
    "session_times": f"""WITH {SESSIONS},{ORDER_DATES},
years AS (SELECT DISTINCT year(date) AS y FROM order_dates),
dst AS (
  SELECT y, a + CAST(7 - isodow(a) AS INTEGER) % 7 AS starts,
    z - CAST(isodow(z) AS INTEGER) % 7 AS ends
  FROM (SELECT y, make_date(y, 4, 1) AS a, make_date(y, 10, 31) AS z FROM years)
),
zoned AS (
  SELECT o.date, CASE WHEN o.date >= starts AND o.date < ends THEN 4 ELSE 5 END AS off
  FROM order_dates o JOIN dst ON y = year(o.date)
  WHERE o.date IN (SELECT date FROM sessions)
)
SELECT date, CAST(date AS TIMESTAMP) + to_minutes(570 + 60 * off) AS open_ts,
  CAST(date AS TIMESTAMP)
    + to_hours(off + CASE WHEN date IN (SELECT d FROM early) THEN 13 ELSE 16 END) AS close_ts
FROM zoned""",
    "session_minutes": f"""WITH {BARS_1MIN},{GRID_1MIN}
SELECT m.timestamp, CAST(m.timestamp AS DATE) AS session_date,
  CAST(count(b.symbol) AS BIGINT) AS n_bars
FROM minutes m LEFT JOIN bars_1min b ON b.timestamp = m.timestamp GROUP BY m.timestamp""",
    "next_session": _neighbour("min", ">=", "next_session"),
    "strictly_next_session": _neighbour("min", ">", "next_session"),
    "previous_session": _neighbour("max", "<", "previous_session"),
    "previous_n_sessions": f"""WITH {SESSIONS},{ORDER_DATES}
SELECT date, CAST(n - 1 AS INTEGER) AS back, session FROM (
  SELECT o.date, s.date AS session,
    row_number() OVER (PARTITION BY o.date ORDER BY s.date DESC) AS n
  FROM order_dates o JOIN sessions s ON s.date < o.date AND s.date >= o.date - 30)
WHERE n <= 3""",
    "ledger_is_complete": f"""WITH {LEDGER}
SELECT date, freq, max_by(status, seq) AS status,
  max_by(status, seq) = 'complete' AS is_complete FROM ledger GROUP BY date, freq""",
    "ledger_missing": f"""WITH {SESSIONS},{LEDGER}
SELECT date FROM sessions WHERE date BETWEEN DATE '1995-01-01' AND DATE '2001-08-01'
  AND date NOT IN (SELECT date FROM ledger WHERE freq = '1min' AND status = 'complete')""",
    "ledger_latest": f"""WITH {LEDGER}
SELECT freq, max(CASE WHEN status = 'complete' THEN date END) AS latest_complete
FROM ledger GROUP BY freq""",
    "ledger_tail": f"""WITH {LEDGER}
SELECT seq, date, freq, status FROM ledger ORDER BY seq DESC LIMIT 50""",
    "ledger_gaps": f"""WITH {SESSIONS},{LEDGER},
done AS (SELECT date FROM ledger WHERE freq = '1d' AND status = 'complete')
SELECT date FROM sessions WHERE date BETWEEN (SELECT min(date) FROM done) AND DATE '2001-08-01'
  AND date NOT IN (SELECT date FROM done)""",
    "update_windows": f"""WITH {SESSIONS},{LEDGER},
latest AS (
  SELECT freq, max(CASE WHEN status = 'complete' THEN date END) AS latest_complete
  FROM ledger GROUP BY freq
),
planned AS (
  SELECT freq, latest_complete,
    coalesce((SELECT min(s.date) FROM sessions s WHERE s.date > latest_complete),
      DATE '1995-01-01') AS s
  FROM latest
)
SELECT freq, latest_complete, CASE WHEN s <= DATE '2001-08-01' THEN s END AS start,
  CASE WHEN s <= DATE '2001-08-01' THEN DATE '2001-08-01' END AS "end",
  CASE WHEN s <= DATE '2001-08-01' THEN 'update' ELSE 'already-current' END AS status
FROM planned""",
    "raw_file_audit": f"""WITH {SESSIONS}
SELECT date, date IN (SELECT CAST(ts AS DATE) FROM events) AS present,
  CAST(date IN (SELECT CAST(ts AS DATE) FROM events) AS BIGINT) AS files
FROM sessions WHERE date BETWEEN DATE '2023-12-18' AND DATE '2024-02-09'""",
    "job_backfill": _SESSION_BARS,
    "stream_ingest": _SESSION_BARS,
    "job_backfill_untidy": f"{_SESSION_BARS} AND CAST(timestamp AS DATE) <> DATE '2024-01-10'",
    "job_backfill_ledger": f"""WITH {SESSIONS}
SELECT date, '1min' AS freq, CASE WHEN date <> DATE '2024-01-10'
  AND date IN (SELECT CAST(ts AS DATE) FROM events) THEN 'complete' ELSE 'failed' END AS status
FROM sessions WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'""",
    "job_incremental_bars": f"""WITH {BARS_EVENT_DAYS},{BARS_1MIN},{SESSIONS},
all_bars AS (
  SELECT *, '1d' AS freq FROM bars_day UNION ALL SELECT *, '1min' AS freq FROM bars_1min
)
SELECT timestamp, symbol, open, high, low, close, close AS vwap,
  CAST(volume AS DOUBLE) AS volume, n_trades, freq
FROM all_bars WHERE CAST(timestamp AS DATE) IN (SELECT date FROM sessions)""",
    "job_incremental_actions": f"""WITH {_SYNCED},
s AS (
  SELECT symbol, day AS date, max(split_from) / min(split_to) AS amount FROM events_of
  GROUP BY symbol, day
),
d AS (SELECT symbol, day AS date, max(cash) AS amount FROM events_of GROUP BY symbol, day)
SELECT 'split' AS kind, date, symbol, amount FROM s
UNION ALL SELECT 'dividend', date, symbol, amount FROM d WHERE amount <> 0""",
    "job_incremental_windows": f"""WITH {SESSIONS},
windows(run, start, "end") AS (VALUES
  (1, DATE '2024-01-01', DATE '2024-01-12'), (2, DATE '2024-01-16', DATE '2024-01-31')),
freqs(freq) AS (VALUES ('1d'), ('1min')),
days AS (
  SELECT run, date, date IN (SELECT CAST(ts AS DATE) FROM events) AS here
  FROM sessions JOIN windows ON date BETWEEN start AND "end"
)
SELECT freq, start, "end", count(*) AS expected, count(*) FILTER (WHERE here) AS present,
  count(*) FILTER (WHERE NOT here) AS missing,
  CASE WHEN freq = '1d' THEN 1 ELSE count(*) FILTER (WHERE here) END AS partitions,
  true AS reference_synced, start AS corporate_actions_start, run
FROM windows JOIN days USING (run) CROSS JOIN freqs GROUP BY freq, start, "end", run""",
    "lake_universe": f"""WITH {BARS_EVENT_DAYS}
SELECT symbol FROM bars_day WHERE CAST(timestamp AS DATE) = DATE '2024-01-18'
ORDER BY close * CAST(volume AS DOUBLE) DESC, symbol LIMIT 3""",
    "stream_universe": _SNAPSHOTS,
    "job_incremental": _SNAPSHOTS,
    "lake_adjusted_prices": _adjusted(
        [
            BARS_1D,
            GRID_1D,
            SPLITS.split("ratios AS")[0]
            + """ratios AS (
  SELECT date, symbol, min_by(split_from / split_to, event_id) AS split_ratio
  FROM splits GROUP BY date, symbol
)""",
            DIVIDENDS.split("cash AS (")[0]
            + """firsts AS (
  SELECT date, symbol, min_by(cash_amount, event_id) AS cash_amount
  FROM dividends GROUP BY date, symbol
),
cash AS (SELECT * FROM firsts WHERE cash_amount <> 0)""",
        ],
        "close",
        _filled("close"),
        _PRICE,
    ),
    "lake_event_merge": f"""WITH {DIVIDENDS},
firsts AS (
  SELECT symbol, date, min(event_id) AS event_id, min_by(cash_amount, event_id) AS cash_amount
  FROM dividends GROUP BY symbol, date
)
SELECT event_id, symbol, CAST(date AS VARCHAR) AS ex_dividend_date,
  CASE WHEN date < DATE '1998-07-01' THEN cash_amount ELSE cash_amount + 1 END AS cash_amount
FROM firsts""",
    "lake_security_master": """SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS symbol,
  s_name AS name, n_name AS exchange,
  CASE WHEN s_suppkey % 3 = 0 THEN 'ETF' ELSE 'CS' END AS type,
  CAST(NULL AS VARCHAR) AS sector, CAST(NULL AS VARCHAR) AS industry, s_acctbal >= 0 AS is_active,
  concat('C-', s_name) AS cik
FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
}

# Day rows of a panel of the days up to the 20th, events moved to the symbol's next date.
_ROLLED_DAYS = """
px_days AS (
  SELECT symbol, CAST(timestamp AS DATE) AS date, close AS px FROM bars_1d
  WHERE day(timestamp) <= 20
),
rolled_ratios AS (
  SELECT symbol, date, product(split_ratio) AS split_ratio FROM (
    SELECT r.symbol, split_ratio,
      (SELECT min(p.date) FROM px_days p WHERE p.symbol = r.symbol AND p.date >= r.date) AS date
    FROM ratios r)
  WHERE date IS NOT NULL GROUP BY symbol, date
),
rolled_cash AS (
  SELECT symbol, date, sum(cash_amount) AS cash_amount FROM (
    SELECT c.symbol, cash_amount,
      (SELECT min(p.date) FROM px_days p WHERE p.symbol = c.symbol AND p.date >= c.date) AS date
    FROM cash c)
  WHERE date IS NOT NULL GROUP BY symbol, date
),
days AS (
  SELECT p.symbol, p.date, p.px, r.split_ratio, c.cash_amount FROM px_days p
  LEFT JOIN rolled_ratios r ON r.symbol = p.symbol AND r.date = p.date
  LEFT JOIN rolled_cash c ON c.symbol = p.symbol AND c.date = p.date
)"""


def _rolled(value: str, name: str) -> str:
    return f"""WITH {BARS_1D},{SPLITS},{DIVIDENDS},{_ROLLED_DAYS},{FACTORS}
SELECT b.timestamp, b.symbol, {value} AS {name} FROM bars_1d b
JOIN factors x ON x.symbol = b.symbol AND x.date = CAST(b.timestamp AS DATE)
WHERE day(b.timestamp) <= 20"""


ORACLES["split_factors_rolled"] = _rolled("x.split_factor", "split_factor")
ORACLES["price_adjustments_rolled"] = _rolled(
    "b.close * x.split_factor * x.dividend_factor", "close"
)

ORACLES["merge_upsert_security_master"] = """
WITH first_issue AS (
  SELECT concat('S', CAST(s_suppkey AS VARCHAR)) AS symbol, s_name AS name, n_name AS exchange,
    CASE WHEN s_suppkey % 3 = 0 THEN 'ETF' ELSE 'CS' END AS type, s_acctbal >= 0 AS is_active,
    s_suppkey % 10 < 5 AS flips, n_name = 'FRANCE' AS moves
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)
SELECT symbol, name, exchange, type, is_active, TIMESTAMP '2024-01-01' AS valid_from,
  CASE WHEN flips THEN TIMESTAMP '2024-01-02' WHEN moves THEN TIMESTAMP '2024-01-04' END AS valid_to
FROM first_issue
UNION ALL
SELECT symbol, name, exchange, type, NOT is_active, TIMESTAMP '2024-01-02',
  CASE WHEN moves THEN TIMESTAMP '2024-01-04' END
FROM first_issue WHERE flips
UNION ALL
SELECT symbol, name, 'PARIS', type, is_active <> flips, TIMESTAMP '2024-01-04', NULL
FROM first_issue WHERE moves"""

ORACLES["security_as_of"] = """
SELECT concat('S', CAST(o_custkey % 10 + 1 AS VARCHAR)) AS symbol,
  CAST(year(o_orderdate) AS INTEGER) AS year,
  CASE WHEN o_orderdate < DATE '1995-01-01' THEN NULL
    WHEN o_orderdate < DATE '1998-01-01' THEN s_acctbal >= 0 ELSE NOT (s_acctbal >= 0) END AS is_active,
  count(*) AS n_orders
FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey % 10 + 1
GROUP BY ALL"""

# Events by symbol and date, the first one of a key, as they were known before and after.
_KNOWN_RATIOS = """
splits AS (
  SELECT concat('S', CAST(o_custkey % 10 AS VARCHAR)) AS symbol, CAST(o_orderdate AS DATE) AS date,
    min_by(pow(2, o_orderkey % 3) / pow(2, (o_orderkey // 3) % 3), o_orderkey) AS split_ratio
  FROM orders GROUP BY ALL
),
ratios AS (SELECT date, symbol, split_ratio FROM splits)"""


def _known_cash(raised: str) -> str:
    return f"""
dividends AS (
  SELECT concat('S', CAST(o_custkey % 10 AS VARCHAR)) AS symbol, CAST(o_orderdate AS DATE) AS date,
    min_by(CAST(o_orderkey % 41 / 4.0 AS DOUBLE) + {raised}, o_orderkey) AS cash_amount
  FROM orders GROUP BY ALL
),
cash AS (SELECT date, symbol, cash_amount FROM dividends WHERE cash_amount <> 0)"""


def _known(raised: str, day: str) -> str:
    panel = _adjusted(
        [BARS_1D, GRID_1D, _KNOWN_RATIOS, _known_cash(raised)], "close", _filled("close"), _PRICE
    )
    return f"SELECT *, DATE '{day}' AS as_of FROM ({panel})"


ORACLES["adjusted_close_panel_as_of"] = (
    _known("0.0", "2002-03-01")
    + " UNION ALL "
    + _known("CASE WHEN o_orderkey % 5 = 0 THEN 1.0 ELSE 0.0 END", "2003-01-01")
)

ORACLES["lake_adjusted_prices_by_symbol"] = ORACLES["lake_adjusted_prices"]

ORACLES["lake_symbol_lookup"] = """
SELECT CAST(l_shipdate AS TIMESTAMP) AS timestamp, CAST(l_partkey AS VARCHAR) AS symbol,
  max(l_extendedprice / l_quantity) AS close, CAST(sum(l_quantity) AS DOUBLE) AS volume
FROM lineitem WHERE l_partkey IN (17, 42) GROUP BY ALL"""

ORACLES["universe_top_n_wide"] = f"SELECT * FROM ({ORACLES['universe_wide_market']}) WHERE rank <= 3"

ORACLES["raw_bars_micros"] = ORACLES["raw_bars_normalised"]

ORACLES["stream_universe_windowed"] = f"""WITH {UNIVERSE}
SELECT * FROM universe
WHERE date + INTERVAL 1 DAY <= (SELECT max(timestamp) FROM bars_1min) - INTERVAL 3 DAY"""

ORACLES["raw_parquet_bars"] = f"""WITH {BARS_EVENT_DAYS}
SELECT timestamp, symbol, close, close AS vwap, CAST(volume AS DOUBLE) AS volume, n_trades,
  CAST(timestamp AS DATE) AS trading_day FROM bars_day"""

ORACLES["universe_days"] = f"""WITH {BARS_EVENT_DAYS},{SESSIONS},{LEDGER}
SELECT CAST(timestamp AS DATE) AS date, symbol, close * CAST(volume AS DOUBLE) AS notional
FROM bars_day WHERE CAST(timestamp AS DATE) IN (
  SELECT date FROM sessions WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
  AND CAST(timestamp AS DATE) NOT IN (
  SELECT date FROM ledger WHERE freq = '1d' AND status = 'complete')"""

ORACLES["source_day_files"] = f"""WITH {BARS_1MIN}
SELECT timestamp, symbol, close, CAST(volume AS DOUBLE) AS volume, n_trades,
  CAST(timestamp AS DATE) AS trading_day FROM bars_1min"""

ORACLES["source_day_stream"] = f"""WITH {BARS_1MIN}
SELECT timestamp, symbol, open, high, low, close, close AS vwap,
  CAST(volume AS DOUBLE) AS volume, n_trades FROM bars_1min"""
