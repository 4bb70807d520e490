"""Corporate actions: event tables, backward factors, adjusted prices and volumes.

Everything is long: ``(date, symbol, split_ratio)``, ``(date, symbol, cash_amount)`` and
panels ``(timestamp, symbol, <field>...)``. The cumulative windows run on day rows only,
one per symbol and date after a pre-aggregation, so a window group can hold no more rows
than there are calendar dates however many bars a symbol has.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickloom.functions.scalars import in_range, finite, not_nan, number, quotient, require_utc

KEYS = ["symbol", "date"]


def build_split_ratios(
    splits: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Split events to one ratio per date and symbol: from / to, multiplied within a day.

    Dates are parsed strictly (bad text fails), numbers leniently (bad text is dropped).
    """
    d = F.col("execution_date").cast("date")
    ratio = finite(F.try_divide(number("split_from"), number("split_to")))
    return (
        splits.select(d.alias("date"), "symbol", ratio.alias("split_ratio"))
        .where(in_range(F.col("date"), start, end))
        .where(F.col("symbol").isNotNull() & F.col("date").isNotNull())
        .where(F.col("split_ratio") > 0)
        .groupBy("date", "symbol")
        .agg(F.product("split_ratio").alias("split_ratio"))
    )


def build_cash_dividends(
    dividends: DataFrame, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Dividend events to one cash amount per date and symbol, summed within a day."""
    d = F.col("ex_dividend_date").cast("date")
    return (
        dividends.select(d.alias("date"), "symbol", number("cash_amount").alias("cash_amount"))
        .where(in_range(F.col("date"), start, end))
        .where(F.col("symbol").isNotNull() & F.col("date").isNotNull())
        .where(F.col("cash_amount") != 0)
        .groupBy("date", "symbol")
        .agg(F.sum("cash_amount").alias("cash_amount"))
    )


def filter_actions(
    table: DataFrame,
    start: date | None = None,
    end: date | None = None,
    symbols: list[str] | None = None,
) -> DataFrame:
    """Rows of an action table within inclusive dates and, if given, for some symbols."""
    out = table.where(in_range(F.col("date"), start, end))
    if symbols is not None:
        out = out.where(F.col("symbol").isin(list(symbols)))
    return out


def price_field_of(panel: DataFrame, field: str | None = None) -> str:
    """The one value column to work on.

    A single-field panel needs no choice; several fields without a (valid) one is an error.
    """
    present = [c for c in panel.columns if c not in ("timestamp", "symbol", "date")]
    if len(present) == 1:
        return present[0]
    if field is None:
        raise ValueError(f"choose one of the fields {present}")
    if field not in present:
        raise ValueError(f"the panel has no field {field!r}, only {present}")
    return field


def daily_last(panel: DataFrame, field: str) -> DataFrame:
    """Last non-null value per symbol and UTC date, null where a date has none.

    ``max_by`` keeps one value per group on the map side, so a day with a third of all
    rows still shuffles one row per symbol and task.
    """
    value = not_nan(F.col(field)) if _is_floating(panel, field) else F.col(field)
    return (
        panel.select("symbol", F.to_date("timestamp").alias("date"), "timestamp",
                     value.alias("px"))
        .groupBy(*KEYS)
        .agg(F.max_by("px", F.when(F.col("px").isNotNull(), F.col("timestamp"))).alias("px"))
    )


def _is_floating(df: DataFrame, field: str) -> bool:
    return df.schema[field].dataType.typeName() in ("double", "float")


def split_step(ratio: Column) -> Column:
    """Sanitised ratio of a date: anything not above zero counts as no split."""
    clean = not_nan(ratio.cast("double"))
    return F.when(clean > 0, clean).otherwise(F.lit(1.0))


def dividend_ratio(cash: Column, prior_close: Column) -> Column:
    """1 - cash / prior close; undefined or infinite counts as no dividend."""
    raw = F.lit(1.0) - F.try_divide(F.coalesce(not_nan(cash), F.lit(0.0)), prior_close)
    return F.coalesce(finite(raw), F.lit(1.0))


def invalid_dividend(cash: Column, prior_close: Column) -> Column:
    """A positive dividend whose ratio is not within (0, 1]."""
    ratio = dividend_ratio(cash, prior_close)
    return F.coalesce((cash > 0) & ~((ratio > 0) & (ratio <= 1)), F.lit(False))


def dividend_step(cash: Column, prior_close: Column) -> Column:
    """Sanitised dividend ratio; a negative amount keeps its ratio above one."""
    return F.when(invalid_dividend(cash, prior_close), F.lit(1.0)).otherwise(
        dividend_ratio(cash, prior_close)
    )


def _before() -> Window:
    return Window.partitionBy("symbol").orderBy("date").rowsBetween(
        Window.unboundedPreceding, -1
    )


def _after() -> Window:
    # Descending with an unbounded-preceding frame is one running product per symbol;
    # an unbounded-following frame would be evaluated anew for every row.
    return Window.partitionBy("symbol").orderBy(F.col("date").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )


def prior_close(px: Column) -> Column:
    """Last non-null day value strictly before the date; the day's own if there is none."""
    return F.coalesce(F.last(px, ignorenulls=True).over(_before()), px)


def add_prior_close(days: DataFrame) -> DataFrame:
    """Day rows with ``px`` to the close a dividend of that date is measured against."""
    return days.withColumn("prior_close", prior_close(F.col("px")))


def add_factors(days: DataFrame, splits: bool = True, dividends: bool = True) -> DataFrame:
    """Backward factors of each day row: the product of all later dates' ratios.

    Splits need ``split_ratio``, dividends ``cash_amount`` and ``prior_close``. Both
    products share one window.
    """
    steps = {}
    if splits:
        steps["split_factor"] = split_step(F.col("split_ratio"))
    if dividends:
        steps["dividend_factor"] = dividend_step(F.col("cash_amount"), F.col("prior_close"))
    days = days.withColumns({f"{n}_step": step for n, step in steps.items()})
    products = {
        n: F.coalesce(F.product(f"{n}_step").over(_after()), F.lit(1.0)) for n in steps
    }
    return days.withColumns(products).drop(*[f"{n}_step" for n in steps])


def action_days(
    panel: DataFrame,
    field: str,
    split_ratios: DataFrame | None = None,
    cash_dividends: DataFrame | None = None,
) -> DataFrame:
    """One row per symbol and date of panel or event, with ``px``, ``split_ratio``,
    ``cash_amount``.

    Panel rows and events meet in one aggregate, so the panel is read once. An event stays on
    a date where the symbol itself has no row but the panel does, as a dense panel would have
    it; events on dates that the panel does not have for any symbol move nothing.
    """
    value = not_nan(F.col(field)) if _is_floating(panel, field) else F.col(field)
    no_px, no_action = F.lit(None).cast(panel.schema[field].dataType), F.lit(None).cast("double")
    rows = panel.select(
        "symbol",
        F.to_date("timestamp").alias("date"),
        "timestamp",
        value.alias("px"),
        no_action.alias("split_ratio"),
        no_action.alias("cash_amount"),
    )
    for events, col in ((split_ratios, "split_ratio"), (cash_dividends, "cash_amount")):
        if events is not None:
            amounts = [F.col(c) if c == col else no_action for c in ("split_ratio", "cash_amount")]
            rows = rows.union(
                events.select("symbol", "date", F.lit(None).cast("timestamp"), no_px, *amounts)
            )
    days = rows.groupBy(*KEYS).agg(
        F.max_by("px", F.when(F.col("px").isNotNull(), F.col("timestamp"))).alias("px"),
        F.max("split_ratio").alias("split_ratio"),
        F.max("cash_amount").alias("cash_amount"),
        F.max(F.col("timestamp").isNotNull()).alias("on_panel"),
    )
    if split_ratios is not None or cash_dividends is not None:
        any_symbol = Window.partitionBy("date")
        days = days.withColumn("on_panel", F.max("on_panel").over(any_symbol)).where("on_panel")
    return days.drop("on_panel")


def rolled_action_days(
    panel: DataFrame,
    field: str,
    split_ratios: DataFrame | None = None,
    cash_dividends: DataFrame | None = None,
) -> DataFrame:
    """Day rows as in ``action_days``, with events moved forward to the symbol's next panel date.

    An event counts on the first date, on or after its own, on which its symbol has a row; what
    falls on one date is multiplied (splits) or added (dividends). Events after the symbol's
    last row move nothing, as do splits that are not above zero.

    The match is no join: days and events of a symbol lie in one window over descending dates,
    in which the last panel date seen is the next one. The regrouping keeps that partitioning.
    """
    value = not_nan(F.col(field)) if _is_floating(panel, field) else F.col(field)
    px_kind, no_action = panel.schema[field].dataType, F.lit(None).cast("double")
    stamp = F.when(F.col("px").isNotNull(), F.col("timestamp"))
    rows = (
        panel.select("symbol", F.to_date("timestamp").alias("date"), "timestamp", value.alias("px"))
        .groupBy(*KEYS)
        .agg(F.max_by("px", stamp).alias("px"))
        .select(*KEYS, "px", no_action.alias("split_ratio"), no_action.alias("cash_amount"),
                F.lit(True).alias("on_panel"))
    )
    for events, col in ((split_ratios, "split_ratio"), (cash_dividends, "cash_amount")):
        if events is not None:
            amounts = [F.col(c) if c == col else no_action for c in ("split_ratio", "cash_amount")]
            rows = rows.union(
                events.select("symbol", "date", F.lit(None).cast(px_kind), *amounts, F.lit(False))
            )
    backward = Window.partitionBy("symbol").orderBy(F.col("date").desc(), F.col("on_panel").desc())
    panel_date = F.when(F.col("on_panel"), F.col("date"))
    ahead = F.last(panel_date, ignorenulls=True).over(
        backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ratio = not_nan(F.col("split_ratio"))
    return (
        rows.withColumn("date", ahead)
        .where(F.col("date").isNotNull())
        .groupBy(*KEYS)
        .agg(
            F.max("px").alias("px"),
            F.product(F.when(ratio > 0, ratio)).alias("split_ratio"),
            F.sum("cash_amount").alias("cash_amount"),
        )
    )


def _days(roll_forward, panel, field, split_ratios=None, cash_dividends=None) -> DataFrame:
    days = rolled_action_days if roll_forward else action_days
    return days(panel, field, split_ratios, cash_dividends)


def _dealt(panel: DataFrame, roll_forward: bool) -> DataFrame:
    """The panel dealt by symbol and date, so that its days and the join back share one exchange
    of it; rows without a symbol or a time, which no event can meet, are left out first, as else
    only one of the two would leave them out. Without rolling, days are summed on the map side.
    """
    if not roll_forward:
        return panel
    date = F.to_date("timestamp")
    return panel.where(F.col("symbol").isNotNull() & date.isNotNull()).repartition("symbol", date)


def action_quality(days: DataFrame) -> DataFrame:
    """One row of counts of repaired or suspicious actions on day rows."""
    return add_prior_close(days).agg(*quality_counts())


def quality_counts(where: Column | None = None) -> list[Column]:
    """Counts over rows with ``split_ratio``, ``cash_amount`` and ``prior_close``.

    A NaN ratio counts as absent, as it does in the factors.
    """
    where = F.lit(True) if where is None else where
    ratio, cash = not_nan(F.col("split_ratio")), F.col("cash_amount")
    return [
        F.count_if(where & (ratio <= 0)).alias("invalid_splits"),
        F.count_if(where & (cash < 0)).alias("negative_dividends"),
        F.count_if(where & invalid_dividend(cash, F.col("prior_close"))).alias(
            "invalid_dividends"
        ),
    ]


def compute_split_factors(
    prices: DataFrame, split_ratios: DataFrame, roll_forward: bool = False
) -> DataFrame:
    """``(timestamp, symbol, split_factor)`` for every panel row.

    ``roll_forward`` lets an event on a date without a row of its symbol count on the next one.
    """
    field, prices = price_field_of(prices), _dealt(prices, roll_forward)
    days = add_factors(_days(roll_forward, prices, field, split_ratios), dividends=False)
    return _spread(prices, days, ["split_factor"]).select("timestamp", "symbol", "split_factor")


def compute_dividend_factors(
    prices: DataFrame,
    cash_dividends: DataFrame,
    price_field: str = "close",
    roll_forward: bool = False,
) -> DataFrame:
    """``(timestamp, symbol, dividend_factor)`` for every panel row, from unadjusted prices."""
    field, prices = price_field_of(prices, price_field), _dealt(prices, roll_forward)
    days = add_prior_close(_days(roll_forward, prices, field, None, cash_dividends))
    days = add_factors(days, splits=False)
    return _spread(prices, days, ["dividend_factor"]).select(
        "timestamp", "symbol", "dividend_factor"
    )


def apply_price_adjustments(
    prices: DataFrame,
    split_ratios: DataFrame,
    cash_dividends: DataFrame,
    price_field: str = "close",
    quality: Observation | None = None,
    roll_forward: bool = False,
) -> DataFrame:
    """Panel price x split factor x dividend factor, as ``(timestamp, symbol, <field>)``.

    Both factors come from one pass over the day rows and one join back to the panel.
    ``quality`` receives the counts of repaired actions once the plan has run.
    """
    field, prices = price_field_of(prices, price_field), _dealt(prices, roll_forward)
    days = add_prior_close(_days(roll_forward, prices, field, split_ratios, cash_dividends))
    if quality is not None:
        days = days.observe(quality, *quality_counts())
    days = add_factors(days)
    adjusted = F.col(field) * F.col("split_factor") * F.col("dividend_factor")
    return _spread(prices, days, ["split_factor", "dividend_factor"]).select(
        "timestamp", "symbol", adjusted.alias(field)
    )


def apply_volume_adjustments(
    volumes: DataFrame,
    split_ratios: DataFrame,
    volume_field: str | None = None,
    roll_forward: bool = False,
) -> DataFrame:
    """Panel volume / split factor, as ``(timestamp, symbol, <field>)``.

    A factor of very many splits can leave the range of a double; over a factor of zero a volume is
    infinite, and no volume NaN, as in pandas.
    """
    field, volumes = price_field_of(volumes, volume_field), _dealt(volumes, roll_forward)
    days = add_factors(_days(roll_forward, volumes, field, split_ratios), dividends=False)
    return _spread(volumes, days, ["split_factor"]).select(
        "timestamp", "symbol", quotient(F.col(field), F.col("split_factor")).alias(field)
    )


def _spread(panel: DataFrame, days: DataFrame, factors: list[str]) -> DataFrame:
    """Day factors to every panel timestamp of that UTC date.

    The join key is symbol and date, so even a symbol with a third of all rows is spread
    over its dates. Every panel row has its day row by construction.
    """
    require_utc(panel.sparkSession)
    keyed = panel.withColumn("date", F.to_date("timestamp"))
    return keyed.join(days.select(*KEYS, *factors), KEYS, "left").fillna(1.0, factors)

