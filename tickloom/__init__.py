"""Equity bar analytics on Spark: panels, corporate actions, universes, ingestion."""

from tickloom.operators.actions import (
    apply_price_adjustments,
    apply_volume_adjustments,
    build_cash_dividends,
    build_split_ratios,
    compute_dividend_factors,
    compute_split_factors,
)
from tickloom.operators.panel import (
    adjusted_price_panel,
    adjusted_volume_panel,
    price_panel,
    to_wide,
)
from tickloom.operators.sessions import (
    previous_n_trading_days as get_previous_n_trading_days,
)
from tickloom.operators.sessions import trading_days as get_trading_days
from tickloom.operators.sessions import trading_minutes as get_trading_minutes
from tickloom.operators.universe import build_universe
from tickloom.plans.jobs import (
    RawSource,
    ReferenceSource,
    backfill_bars,
    run_incremental_update,
    sync_corporate_actions,
    sync_security_master,
)
from tickloom.plans.prices import (
    get_universe,
    load_adjusted_prices,
    load_adjusted_volumes,
    load_prices,
)
from tickloom.sinks.lake import (
    build_corporate_actions_tables,
    build_dividend_cash_table,
    build_split_ratio_table,
    write_bars,
    write_dividends,
    write_security_master,
    write_splits,
    write_universe,
)
from tickloom.sources.lake import (
    Lake,
    load_dividend_cash_table,
    load_security_master,
    load_split_ratio_table,
    load_universe_snapshot,
)

__all__ = [
    "Lake",
    "RawSource",
    "ReferenceSource",
    "adjusted_price_panel",
    "adjusted_volume_panel",
    "apply_price_adjustments",
    "apply_volume_adjustments",
    "backfill_bars",
    "build_cash_dividends",
    "build_corporate_actions_tables",
    "build_dividend_cash_table",
    "build_split_ratio_table",
    "build_split_ratios",
    "build_universe",
    "compute_dividend_factors",
    "compute_split_factors",
    "get_previous_n_trading_days",
    "get_trading_days",
    "get_trading_minutes",
    "get_universe",
    "load_adjusted_prices",
    "load_adjusted_volumes",
    "load_dividend_cash_table",
    "load_prices",
    "load_security_master",
    "load_split_ratio_table",
    "load_universe_snapshot",
    "price_panel",
    "run_incremental_update",
    "sync_corporate_actions",
    "sync_security_master",
    "to_wide",
    "write_bars",
    "write_dividends",
    "write_security_master",
    "write_splits",
    "write_universe",
]
