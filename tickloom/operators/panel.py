"""Price and volume panels: calendar grid, gap fill, optional action factors.

Panels are long, ``(timestamp, symbol, <field>...)``, and dense: every symbol that has a
row in the range gets every grid timestamp. ``to_wide`` pivots at the edge.

Minute panels work per (symbol, session date). Bars are scanned and shuffled once, by
those two columns, so a symbol with a third of all rows is spread over its dates and no
group holds more than one session. What has to cross dates - the value carried into a
session and the action factors - is computed on day rows. Dense minutes are generated
last, from the gap after each bar, and are never shuffled.

Daily panels have one row per symbol and timestamp; the dense grid gives all symbols the
same number of rows, so windows by symbol are balanced by construction.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import calendar as cal
from tickloom.functions.scalars import (
    freq_checked,
    instant,
    not_nan,
    quotient,
    require_utc,
    to_utc,
    utc_date,
)
from tickloom.operators import actions as act
from tickloom.operators.sessions import calendar_days
from tickloom.schemas import PRICE_FIELDS, VALUE_FIELDS


@dataclass(frozen=True)
class PanelRequest:
    """Validated arguments of a panel query; instants are inclusive and in UTC."""

    freq: str
    symbols: tuple[str, ...]
    start: datetime
    end: datetime
    fields: tuple[str, ...]
    fill: bool = True
    closed: str = "left"
    buckets: int | None = None

    @property
    def days(self) -> tuple[date, date]:
        return utc_date(self.start), utc_date(self.end)


def panel_request(
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    fields: list[str] | None = None,
    fill_missing_bars: bool = True,
    closed: str = "left",
    buckets: int | None = None,
) -> PanelRequest:
    """Check the arguments; naive datetimes are taken as UTC, and a plain date as end means
    the whole of that day. ``buckets`` says that the bars are dealt by symbol into so many."""
    if not symbols:
        raise ValueError("symbols must be a non-empty list")
    freq_checked(freq)
    fields = list(fields or ["close"])
    for field in fields:
        if field not in VALUE_FIELDS:
            raise ValueError(f"Unsupported field: {field}")
    return PanelRequest(
        freq,
        tuple(sorted(set(symbols))),
        to_utc(_whole_day(start, time.min)),
        to_utc(_whole_day(end, time.max)),
        tuple(dict.fromkeys(fields)),
        fill_missing_bars,
        closed,
        buckets if freq == "1d" else None,
    )


def _whole_day(value: datetime | date, edge: time) -> datetime:
    return value if isinstance(value, datetime) else datetime.combine(value, edge)


def requested_rows(bars: DataFrame, req: PanelRequest) -> DataFrame:
    """Project and filter; both conditions reach the Parquet scan. NaN counts as missing."""
    values = [
        not_nan(F.col(f)).alias(f) if _kind(bars, f) in ("double", "float") else F.col(f)
        for f in req.fields
    ]
    rows = bars.where(
        F.col("symbol").isin(list(req.symbols))
        & F.col("timestamp").between(instant(req.start), instant(req.end))
    ).select("timestamp", "symbol", *values)
    if len(req.fields) > 1:
        rows = rows.where(F.coalesce(*[F.col(f).cast("double") for f in req.fields]).isNotNull())
    return rows


def price_panel(
    bars: DataFrame,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    fields: list[str] | None = None,
    fill_missing_bars: bool = True,
    closed: str = "left",
    buckets: int | None = None,
) -> DataFrame:
    """Dense long panel. Prices are carried forward, volume and trade counts filled with 0;
    there is no back fill, and nothing is carried in from before ``start``.

    Two bars of one symbol at one time are an error in a single-field panel and averaged
    in a multi-field one. Daily bars read from a table of so many ``buckets`` by symbol are
    not exchanged.
    """
    req = panel_request(freq, symbols, start, end, fields, fill_missing_bars, closed, buckets)
    panel = _build(bars, req)
    return panel.select("timestamp", "symbol", *req.fields)


def adjusted_price_panel(
    bars: DataFrame,
    split_ratios: DataFrame,
    cash_dividends: DataFrame,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    price_field: str = "close",
    quality: Observation | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Filled prices x split factor x dividend factor, relative to the end of the range.

    ``quality`` receives the counts of repaired actions once the plan has run.
    """
    req = panel_request(freq, symbols, start, end, [price_field], buckets=buckets)
    panel = _build(bars, req, split_ratios, cash_dividends, quality)
    adjusted = F.col(price_field) * F.col("split_factor") * F.col("dividend_factor")
    return panel.select("timestamp", "symbol", adjusted.alias(price_field))


def adjusted_volume_panel(
    bars: DataFrame,
    split_ratios: DataFrame,
    freq: str,
    symbols: list[str],
    start: datetime,
    end: datetime,
    volume_field: str = "volume",
    buckets: int | None = None,
) -> DataFrame:
    """Filled volumes / split factor; over a factor of zero as in ``apply_volume_adjustments``."""
    req = panel_request(freq, symbols, start, end, [volume_field], buckets=buckets)
    panel = _build(bars, req, split_ratios)
    adjusted = quotient(F.col(volume_field), F.col("split_factor"))
    return panel.select("timestamp", "symbol", adjusted.alias(volume_field))


def _build(
    bars: DataFrame,
    req: PanelRequest,
    splits: DataFrame | None = None,
    dividends: DataFrame | None = None,
    quality: Observation | None = None,
) -> DataFrame:
    require_utc(bars.sparkSession)
    build = _minute_panel if req.freq == "1min" else _daily_panel
    return build(requested_rows(bars, req), req, splits, dividends, quality)


def _actions_asked(req: PanelRequest, splits, dividends) -> list[tuple[DataFrame, str]]:
    """Action tables limited to the dates and symbols of the request."""
    asked = []
    for table, col in ((splits, "split_ratio"), (dividends, "cash_amount")):
        if table is not None:
            part = act.filter_actions(table, *req.days, symbols=list(req.symbols))
            asked.append((part.select("symbol", "date", col), col))
    return asked


def _duplicate_guard(value: Column, is_duplicate: Column, kind: str) -> Column:
    message = F.lit("Duplicate bar for one symbol and timestamp; deduplicate before the panel")
    return F.when(is_duplicate, F.raise_error(message).cast(kind)).otherwise(value)


def _averaged(rows: DataFrame, keys: list[str], fields: tuple[str, ...]) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.avg(f).alias(f) for f in fields])


def _kind(rows: DataFrame, field: str) -> str:
    return rows.schema[field].dataType.simpleString()


# ---------------------------------------------------------------- daily


def _daily_panel(rows, req, splits, dividends, quality) -> DataFrame:
    """Bars, the grid and the actions are dealt by symbol once, as one table; what belongs to
    one symbol and time, or to one symbol and date, then meets inside that partitioning. Bars
    that lie in buckets by symbol are dealt already, and the others join them there."""
    asked = _actions_asked(req, splits, dividends)
    kinds = {f: rows.schema[f].dataType for f in req.fields}
    kinds |= {col: table.schema[col].dataType for table, col in asked}

    def side(df: DataFrame, **have: Column) -> DataFrame:
        """Columns of the common table; null where this side has none."""
        cols = {"timestamp": F.lit(None).cast("timestamp"), "has_bar": F.lit(None).cast("boolean")}
        cols |= {c: F.lit(None).cast(kind) for c, kind in kinds.items()}
        cols |= {"date": F.to_date("timestamp")} if "timestamp" in have else {}
        cols |= have
        return df.select("symbol", *[c.alias(name) for name, c in sorted(cols.items())])

    stamp = {"timestamp": F.col("timestamp")}
    bars = side(rows, **stamp, has_bar=F.lit(True), **{f: F.col(f) for f in req.fields})
    # Every observed timestamp for every asked symbol; the list is part of the request.
    grid = rows.select("timestamp").distinct().select(
        "timestamp", F.explode(F.lit(list(req.symbols))).alias("symbol")
    )
    others = [side(grid, **stamp)]
    others += [side(table, date=F.col("date"), **{col: F.col(col)}) for table, col in asked]
    if req.buckets:
        others = [df.repartition(req.buckets, "symbol") for df in others]
        # Spark compares how the sides of a union are dealt by their output columns; a column of
        # a catalog table counts as its own output only under a name of its own
        bars = bars.withColumnRenamed("symbol", "bucket_symbol")
        parts = reduce(DataFrame.union, [*others, bars])
    else:
        parts = reduce(DataFrame.union, others, bars).repartition("symbol")
    names = [col for _, col in asked]
    if asked:
        same_day = Window.partitionBy("symbol", "date")
        parts = parts.withColumns({c: F.max(c).over(same_day) for c in names})
    meet = F.max if len(req.fields) == 1 else F.avg
    panel = (
        parts.where(F.col("timestamp").isNotNull())
        .groupBy("symbol", "timestamp")
        .agg(
            F.max("date").alias("date"),
            F.count("has_bar").alias("n_bars"),
            *[meet(f).alias(f) for f in req.fields],
            *[F.max(c).alias(c) for c in names],
        )
    )
    by_time = Window.partitionBy("symbol").orderBy("timestamp")
    whole = by_time.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cols = {"observed": F.max(F.col("n_bars") > 0).over(whole)}
    if len(req.fields) == 1:
        (field,) = req.fields
        cols[field] = _duplicate_guard(F.col(field), F.col("n_bars") > 1, _kind(rows, field))
    panel = panel.withColumns(cols).where("observed")
    if req.fill:
        upto = by_time.rowsBetween(Window.unboundedPreceding, 0)
        panel = panel.withColumns(
            {
                f: F.last(f, ignorenulls=True).over(upto)
                if f in PRICE_FIELDS
                else F.coalesce(F.col(f), F.lit(0))
                for f in req.fields
            }
        )
    return _daily_factors(panel, req.fields[0], asked, by_time, quality) if asked else panel


def _daily_factors(panel, field, asked, by_time, quality) -> DataFrame:
    """Backward factors on the dense panel itself: the panel is already partitioned by
    symbol, so frames over the date replace a day table and a join back.

    An event counts once per date, on the date's first timestamp.
    """
    day = F.unix_date("date")
    by_day = Window.partitionBy("symbol").orderBy(day)
    later = Window.partitionBy("symbol").orderBy(day.desc()).rangeBetween(
        Window.unboundedPreceding, -1
    )
    stamp = F.when(F.col(field).isNotNull(), F.col("timestamp"))
    panel = panel.withColumn(
        "first_of_day", F.coalesce(F.lag("date").over(by_time) != F.col("date"), F.lit(True))
    )
    steps = {}
    names = [col for _, col in asked]
    if "split_ratio" in names:
        steps["split_factor"] = act.split_step(F.col("split_ratio"))
    if "cash_amount" in names:
        before = by_day.rangeBetween(Window.unboundedPreceding, -1)
        panel = panel.withColumn(
            "prior_close",
            F.coalesce(
                F.max_by(field, stamp).over(before),
                F.max_by(field, stamp).over(by_day.rangeBetween(0, 0)),
            ),
        )
        steps["dividend_factor"] = act.dividend_step(F.col("cash_amount"), F.col("prior_close"))
    if quality is not None:
        panel = panel.observe(quality, *act.quality_counts(F.col("first_of_day")))
    once = {
        name: F.when(F.col("first_of_day"), step).otherwise(F.lit(1.0))
        for name, step in steps.items()
    }
    panel = panel.withColumns({f"{n}_step": step for n, step in once.items()})
    return panel.withColumns(
        {n: F.coalesce(F.product(f"{n}_step").over(later), F.lit(1.0)) for n in once}
    )


# ---------------------------------------------------------------- minutes


def _minute_panel(rows, req, splits, dividends, quality) -> DataFrame:
    keys = ["symbol", "date"]
    bars = _on_session_grid(rows, req)
    # One exchange serves the day summary and the fill.
    bars = bars.repartition(*keys)
    if len(req.fields) > 1:
        bars = _averaged(bars, [*keys, "timestamp"], req.fields)

    days = _session_days(rows.select("symbol").distinct(), req)
    carried = [f for f in req.fields if f in PRICE_FIELDS] if req.fill else []
    asked = _actions_asked(req, splits, dividends)
    summary = carried or ([req.fields[0]] if any(c == "cash_amount" for _, c in asked) else [])
    if summary:
        last = [
            F.max_by(f, F.when(F.col(f).isNotNull(), F.col("timestamp"))).alias(f"day_{f}")
            for f in summary
        ]
        days = days.join(bars.groupBy(*keys).agg(*last), keys, "left")
    for table, _ in asked:
        days = days.join(table, keys, "left")
    before = Window.partitionBy("symbol").orderBy("date").rowsBetween(
        Window.unboundedPreceding, -1
    )
    days = days.withColumns(
        {f"carry_{f}": F.last(f"day_{f}", ignorenulls=True).over(before) for f in carried}
    )
    names = [col for _, col in asked]
    if "cash_amount" in names:
        days = act.add_prior_close(days.withColumn("px", F.col(f"day_{req.fields[0]}")))
    if quality is not None:
        days = days.observe(quality, *act.quality_counts())
    if names:
        days = act.add_factors(days, "split_ratio" in names, "cash_amount" in names)

    by_time = Window.partitionBy(*keys).orderBy("timestamp")
    upto = by_time.rowsBetween(Window.unboundedPreceding, 0)
    following = F.lead("timestamp").over(by_time)
    again = F.coalesce(following == F.col("timestamp"), F.lit(False))
    cols = {
        "first": F.lag("timestamp").over(by_time).isNull(),
        "following": _duplicate_guard(following, again, "timestamp"),
        **{f"held_{f}": F.last(f, ignorenulls=True).over(upto) for f in carried},
    }
    # The windows come before the join: their sort order also serves the merge join.
    spans = days.join(bars.withColumns(cols), keys, "left")
    minute = F.expr("interval 1 minute")
    begin = F.when(F.coalesce("first", F.lit(True)), F.col("first_minute")).otherwise(
        F.col("timestamp")
    )
    until = F.coalesce(F.col("following") - minute, F.col("last_minute"))
    spans = spans.withColumn("tick", F.explode(F.sequence(begin, until, minute)))
    out = {f: _minute_value(f, f in carried, req.fill) for f in req.fields}
    factors = [c for c in ("split_factor", "dividend_factor") if c in spans.columns]
    return spans.select(
        F.col("tick").alias("timestamp"),
        "symbol",
        *[c.alias(f) for f, c in out.items()],
        *factors,
    )


def _minute_value(field: str, carried: bool, fill: bool) -> Column:
    """Value of one minute between a bar and the next: the bar itself, the price held
    since it, or (ahead of the session's first bar) the price carried into the session."""
    at_bar = F.coalesce(F.col("tick") == F.col("timestamp"), F.lit(False))
    if carried:
        ahead = F.coalesce(F.col("tick") < F.col("timestamp"), F.lit(True))
        held = F.coalesce(F.col(f"held_{field}"), F.col(f"carry_{field}"))
        return F.when(ahead, F.col(f"carry_{field}")).otherwise(held)
    if fill:
        return F.when(at_bar, F.coalesce(F.col(field), F.lit(0))).otherwise(F.lit(0))
    return F.when(at_bar, F.col(field))


def _session_bounds(days: DataFrame, req: PanelRequest) -> DataFrame:
    """Session dates of ``days`` with their first and last minute inside the request."""
    first, last = cal.minute_bounds("date", req.closed)
    up = req.start + timedelta(minutes=1, microseconds=-1)
    return (
        days.where(cal.is_session("date"))
        .withColumns(
            {
                "first_minute": F.greatest(
                    first, instant(up.replace(second=0, microsecond=0))
                ),
                "last_minute": F.least(
                    last, instant(req.end.replace(second=0, microsecond=0))
                ),
            }
        )
        .where(F.col("first_minute") <= F.col("last_minute"))
    )


def _on_session_grid(rows: DataFrame, req: PanelRequest) -> DataFrame:
    """Bars stamped on a session minute; others are dropped before any fill.

    The broadcast side has one row per session of the request, at most one per calendar
    day of 1990-2099 whatever the size of the bars.
    """
    sessions = _session_bounds(calendar_days(rows.sparkSession, *req.days), req)
    dated = rows.withColumn("date", F.to_date("timestamp")).where(
        F.date_trunc("minute", "timestamp") == F.col("timestamp")
    )
    inside = F.col("timestamp").between(F.col("first_minute"), F.col("last_minute"))
    return dated.join(F.broadcast(sessions), "date").where(inside).select(*rows.columns, "date")


def _session_days(seen: DataFrame, req: PanelRequest) -> DataFrame:
    """Each seen symbol on each session with its grid bounds. ``seen`` is no longer than
    the request's symbol list, the dates are a literal range: nothing is joined."""
    lo, hi = req.days
    dates = F.sequence(F.lit(lo), F.lit(hi))
    return _session_bounds(seen.select("symbol", F.explode(dates).alias("date")), req)


# ---------------------------------------------------------------- edge


def to_wide(
    panel: DataFrame, fields: list[str] | None = None, symbols: list[str] | None = None
) -> DataFrame:
    """Pivot to one row per timestamp, ordered by time.

    One field gives a column per symbol, several give ``<field>_<symbol>`` with the fields
    sorted. Without a symbol list the observed symbols are used, sorted.
    """
    fields = sorted(fields or [f for f in VALUE_FIELDS if f in panel.columns])
    if symbols is None:
        symbols = sorted(r.symbol for r in panel.select("symbol").distinct().collect())
    pivoted = panel.groupBy("timestamp").pivot("symbol", list(symbols))
    if len(fields) == 1:
        return pivoted.agg(F.first(fields[0])).orderBy("timestamp")
    wide = pivoted.agg(*[F.first(f).alias(f) for f in fields])
    names = [
        F.col(f"`{symbol}_{field}`").alias(f"{field}_{symbol}")
        for field in fields
        for symbol in symbols
    ]
    return wide.select("timestamp", *names).orderBy("timestamp")


def symbol_dictionary(rows: DataFrame) -> DataFrame:
    """``(slot, symbol, n_slots)``: the symbols of a panel or of bars, numbered in their order.

    The list is made in one aggregate: it is no longer than one row of the matrix that it is for.
    """
    found = rows.where(F.col("symbol").isNotNull()).agg(F.sort_array(F.collect_set("symbol")).alias("symbols"))
    return found.select(F.posexplode("symbols").alias("slot", "symbol"), F.size("symbols").alias("n_slots"))


def to_matrix(panel: DataFrame, dictionary: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One row per timestamp, each field an array with one value per slot of the dictionary.

    A wide panel past what columns can name: symbols are not collected to the driver, and the plan
    does not grow with them. Symbols that are not in the dictionary are left out, slots without a
    row are null, and a symbol that comes twice at one time is an error. Rows are in no order.
    """
    fields = list(fields or [f for f in VALUE_FIELDS if f in panel.columns])
    slots = panel.select("timestamp", "symbol", *fields).join(dictionary, "symbol")
    cells = F.sort_array(F.collect_list(F.struct("slot", *fields)))
    rows = slots.groupBy("timestamp").agg(cells.alias("cells"), F.first("n_slots").alias("n_slots"))
    return rows.select("timestamp", *[_aligned(panel, f).alias(f) for f in fields])


def _aligned(panel: DataFrame, field: str) -> Column:
    """Sorted cells of a time as an array by slot: nulls before the first, and after each cell up to
    the next one's slot. Each cell is looked at once."""
    kind, cells, width = panel.schema[field].dataType, F.col("cells"), F.col("n_slots")

    def nulls(n: Column) -> Column:
        return F.array_repeat(F.lit(None).cast(kind), n.cast("int"))

    def run(cell: Column, i: Column) -> Column:
        after = F.coalesce(F.get(cells, i + 1)["slot"], width)
        return F.concat(F.array(cell[field]), nulls(after - cell["slot"] - 1))

    ahead = nulls(F.get(cells, F.lit(0))["slot"])
    out = F.concat(ahead, F.flatten(F.transform(cells, run)))
    twice = F.raise_error(F.concat(F.lit("a symbol comes twice at "), F.col("timestamp").cast("string")))
    return F.when(F.size(out) == width, out).otherwise(twice.cast(T.ArrayType(kind)))


def from_matrix(matrix: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The long form of a matrix: a row per timestamp and slot, nulls included."""
    fields = [c for c in matrix.columns if c != "timestamp"]
    cells = matrix.select("timestamp", F.posexplode(F.arrays_zip(*fields)).alias("slot", "cell"))
    rows = cells.join(dictionary.drop("n_slots"), "slot")
    return rows.select("timestamp", "symbol", "slot", *[F.col(f"cell.{f}").alias(f) for f in fields])
