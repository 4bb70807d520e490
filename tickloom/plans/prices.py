"""Queries against a lake: prices, adjusted prices, adjusted volumes, universe lists."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation

from tickloom.operators import panel, universe
from tickloom.operators.panel import PanelRequest, panel_request
from tickloom.sources.lake import (
    Lake,
    load_dividend_cash_table,
    load_split_ratio_table,
    load_universe_snapshot,
    scan_bars,
    scan_bars_by_symbol,
)


def load_prices(
    lake: Lake,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    fields: list[str] | None = None,
    fill_missing_bars: bool = True,
    layout: str = "date",
) -> DataFrame:
    """Long panel ``(timestamp, symbol, <field>...)``; ``panel.to_wide`` pivots it.

    A range without bars gives an empty frame of the same columns. ``layout="symbol"`` reads
    daily bars as laid out by symbol, which long ranges and few symbols gain from.
    """
    req = panel_request(freq, symbols, start, end, fields, fill_missing_bars)
    bars, buckets = _bars(lake, req, layout)
    return panel.price_panel(
        bars, freq, symbols, req.start, req.end, list(req.fields), fill_missing_bars, buckets=buckets
    )


def _bars(lake: Lake, req: PanelRequest, layout: str) -> tuple[DataFrame, int | None]:
    """Bars of the request's range from one of their layouts, and its buckets."""
    if layout not in ("date", "symbol"):
        raise ValueError(f"layout is date or symbol, not {layout!r}")
    if layout == "symbol" and req.freq == "1d":
        return scan_bars_by_symbol(lake, req.start, req.end)
    return scan_bars(lake, req.freq, req.start, req.end), None


def _actions(
    loader, lake: Lake, req: PanelRequest, as_of: datetime | date | None = None
) -> DataFrame:
    start, end = req.days
    return loader(lake, start=start, end=end, symbols=list(req.symbols), as_of=as_of)


def load_adjusted_prices(
    lake: Lake,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    price_field: str = "close",
    quality: Observation | None = None,
    as_of: datetime | date | None = None,
    layout: str = "date",
) -> DataFrame:
    """Split- and dividend-adjusted prices, relative to the end of the range.

    ``as_of`` adjusts by the events as they were known then, before later corrections.
    """
    req = panel_request(freq, symbols, start, end, [price_field])
    bars, buckets = _bars(lake, req, layout)
    return panel.adjusted_price_panel(
        bars,
        _actions(load_split_ratio_table, lake, req, as_of),
        _actions(load_dividend_cash_table, lake, req, as_of),
        freq,
        symbols,
        req.start,
        req.end,
        price_field,
        quality,
        buckets,
    )


def load_adjusted_volumes(
    lake: Lake,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    volume_field: str = "volume",
    as_of: datetime | date | None = None,
    layout: str = "date",
) -> DataFrame:
    """Split-adjusted volumes, relative to the end of the range, by the splits known ``as_of``."""
    req = panel_request(freq, symbols, start, end, [volume_field])
    bars, buckets = _bars(lake, req, layout)
    return panel.adjusted_volume_panel(
        bars,
        _actions(load_split_ratio_table, lake, req, as_of),
        freq,
        symbols,
        req.start,
        req.end,
        volume_field,
        buckets,
    )


def get_universe(lake: Lake, day: date, top_n: int | None = None) -> DataFrame:
    """Symbols of a day's snapshot, largest notional first; empty without a snapshot."""
    return universe.top_symbols(load_universe_snapshot(lake, day), day, top_n).select("symbol")
