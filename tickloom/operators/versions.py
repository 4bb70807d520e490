"""Versions of dimension rows and events: what was valid, or known, from when until when.

A history holds every version of a key with ``valid_from`` (inclusive; null: since ever) and
``valid_to`` (exclusive; null: until further notice). Batches that re-issue a key close its
version and open the next one; batches that repeat what is known change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalars import instant, to_utc
from tickloom.operators.merge import drop_duplicates_keep_first

VALID_FROM, VALID_TO = "valid_from", "valid_to"
PERIOD = (VALID_FROM, VALID_TO)

#: Partition column of a stored history, and how many partitions keys are dealt over.
PART, PARTS = "part", 64

PERIOD_FIELDS = [T.StructField(c, T.TimestampType()) for c in PERIOD]


def moment(at: datetime | date) -> Column:
    """A literal instant; a plain date is its beginning in UTC."""
    if not isinstance(at, datetime):
        at = datetime(at.year, at.month, at.day)
    return instant(to_utc(at))


def part_of(key: Sequence[str]) -> Column:
    """The partition of a key: a function of its values alone."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in key])
    return F.pmod(F.xxhash64(text), F.lit(PARTS)).cast("int")


def next_versions(
    history: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    at: datetime | date,
    update: bool = True,
) -> DataFrame:
    """The history after a batch, with ``touched``: whether the batch changed the row or added it.

    Keys that were not there get a version from ``at`` on. A key whose values differ from its
    open version has that version closed at ``at`` and gets a new one, unless the open version
    is younger than the batch: late news does not undo what is known. ``update=False`` only
    adds keys. The batch's first row of a key counts. Columns that only one side has are null
    on the other; a column that the batch lacks keeps its value.

    Open versions and the batch meet in one aggregate by key, so neither is joined, and are
    compared value by value, nulls equal; closed versions pass by.
    """
    key = list(key)
    known = [c for c in history.columns if c not in (*key, *PERIOD)]
    given = [c for c in incoming.columns if c not in key]
    values = [*known, *[c for c in given if c not in known]]
    kinds = {f.name: f.dataType for f in (*incoming.schema.fields, *history.schema.fields)}
    shape = T.StructType([T.StructField(c, kinds[c]) for c in values])

    def packed(have: Sequence[str]) -> Column:
        cells = [F.col(f"`{c}`") if c in have else F.lit(None) for c in values]
        return F.struct(*[x.cast(kinds[c]).alias(c) for c, x in zip(values, cells, strict=True)])

    no_row, no_time, when = F.lit(None).cast(shape), F.lit(None).cast("timestamp"), moment(at)
    stored = history.where(F.col(VALID_TO).isNull()).select(
        *key, packed(known).alias("old"), F.col(VALID_FROM).alias("since"), no_row.alias("new")
    )
    sent = drop_duplicates_keep_first(incoming, key).select(
        *key, no_row.alias("old"), no_time.alias("since"), packed(given).alias("new")
    )
    met = stored.union(sent).groupBy(*key).agg(
        F.first("old", ignorenulls=True).alias("old"),
        F.max("since").alias("since"),
        F.first("new", ignorenulls=True).alias("new"),
    )
    merged = F.struct(
        *[F.col(f"new.`{c}`" if c in given else f"old.`{c}`").alias(c) for c in values]
    )
    met = met.withColumn("new", F.when(F.col("new").isNotNull(), merged))
    added = F.col("old").isNull()
    in_time = F.col("since").isNull() | (F.col("since") <= when)
    differs = F.col("new").isNotNull() & ~F.col("old").eqNullSafe(F.col("new"))
    replaced = ~added & differs & in_time & F.lit(update)

    def version(row: str, start: Column, end: Column, touched: Column) -> Column:
        return F.struct(
            F.col(row).alias("row"), start.alias(VALID_FROM), end.alias(VALID_TO), touched.alias("touched")
        )

    old = version("old", F.col("since"), F.when(replaced, when), replaced)
    new = version("new", when, no_time, F.lit(True))
    # a version that is replaced at the instant it began never held
    at_once = replaced & F.coalesce(F.col("since") == when, F.lit(False))
    versions = (
        F.when(added | at_once, F.array(new)).when(replaced, F.array(old, new)).otherwise(F.array(old))
    )
    after = met.select(*key, F.explode(versions).alias("v")).select(
        *key,
        *[F.col(f"v.row.`{c}`").alias(c) for c in values],
        *[F.col(f"v.{c}").alias(c) for c in (*PERIOD, "touched")],
    )
    closed = history.where(F.col(VALID_TO).isNotNull()).withColumn("touched", F.lit(False))
    return after.unionByName(closed, allowMissingColumns=True)


def valid_at(at: Column) -> Column:
    """Whether a version holds at an instant."""
    begun = F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= at)
    return begun & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))


def as_of(history: DataFrame, at: datetime | date | None = None) -> DataFrame:
    """The one version of each key that holds at ``at`` (default: the open one), without its period.

    A plain date means its beginning, as in ``next_versions``. Both conditions reach the scan.
    """
    holds = F.col(VALID_TO).isNull() if at is None else valid_at(moment(at))
    return history.where(holds).drop(*PERIOD)


def join_versions(
    facts: DataFrame, history: DataFrame, key: Sequence[str], time: str, how: str = "left"
) -> DataFrame:
    """Facts with the version of their key that held at the fact's own time.

    An equality join on the key with the period as a further condition: versions of a key do
    not overlap, so a fact meets one at most and the join makes no more rows than facts. A hot
    key is split by Spark's skew handling, since the condition needs no order.
    """
    versions = history.select(
        *[F.col(c).alias(f"_{c}") if c in (*key, *PERIOD) else F.col(c) for c in history.columns]
    )
    same = [facts[k].eqNullSafe(versions[f"_{k}"]) for k in key]
    begun = versions[f"_{VALID_FROM}"].isNull() | (versions[f"_{VALID_FROM}"] <= facts[time])
    lasts = versions[f"_{VALID_TO}"].isNull() | (versions[f"_{VALID_TO}"] > facts[time])
    joined = facts.join(versions, reduce(lambda a, b: a & b, [*same, begun, lasts]), how)
    return joined.drop(*[f"_{c}" for c in (*key, *PERIOD)])
