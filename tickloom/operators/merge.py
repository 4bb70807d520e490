"""Keep-first deduplication and insert-only merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGEST_SEQ = "ingest_seq"
BAR_KEY = ("timestamp", "symbol")

# Columns to fall back on, in this order, when no preferred key exists.
FALLBACK_KEYS = ("symbol", "date", "execution_date", "ex_dividend_date")


def dedupe_columns(df: DataFrame, preferred: Sequence[str]) -> list[str]:
    """Preferred key columns that exist, else the fallback ones that do, else all."""
    for choice in (preferred, FALLBACK_KEYS):
        present = [c for c in choice if c in df.columns]
        if present:
            return present
    return list(df.columns)


def with_ingest_order(df: DataFrame, *before: Column) -> DataFrame:
    """Attach the input order of a scan.

    ``monotonically_increasing_id`` grows with the row position inside one file split;
    ``before`` puts source columns (trading day, file, block) in front of it.
    """
    position = F.monotonically_increasing_id()
    return df.withColumn(INGEST_SEQ, F.struct(*before, position) if before else position)


def _fixed_width(kind: T.DataType) -> bool:
    return isinstance(
        kind, (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType)
    )


def drop_duplicates_keep_first(
    df: DataFrame, key: Sequence[str], order: str | None = None
) -> DataFrame:
    """The first row of each key by the column ``order`` (default: the input order), which
    must be unique within a key; it is dropped if it is the attached input order.

    An aggregate rather than a ranking window: copies collapse on the map side, so a key
    with a third of all rows shuffles one row per task. Null keys equal each other. Where
    all values have a fixed width they are aggregated one by one, which keeps Spark's hash
    aggregate; otherwise they go as one struct through a sort aggregate.
    """
    columns = [c for c in df.columns if c != INGEST_SEQ]
    if order is None:
        if INGEST_SEQ not in df.columns:
            df = with_ingest_order(df)
        order = INGEST_SEQ
    rest = [c for c in columns if c not in key]
    if not rest:
        return df.select(*columns).distinct()
    if all(_fixed_width(df.schema[c].dataType) for c in (order, *rest)):
        values = [F.min_by(F.col(f"`{c}`"), order).alias(c) for c in rest]
        return df.groupBy(*key).agg(*values).select(*columns)
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), order).alias("_first"))
    return first.select(*[F.col(f"_first.`{c}`") if c in rest else F.col(c) for c in columns])


def new_rows(existing: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``new`` (already unique by key) whose key does not exist yet."""
    have = existing.select(*[F.col(k).alias(f"_have_{k}") for k in key])
    cond = reduce(
        lambda a, b: a & b, [new[k].eqNullSafe(have[f"_have_{k}"]) for k in key]
    )
    return new.join(have, cond, "left_anti")


def merge_keep_existing(
    existing: DataFrame,
    new: DataFrame,
    key: Sequence[str] = BAR_KEY,
    order: str | None = None,
) -> DataFrame:
    """Existing rows win, new keys are inserted, nothing is updated.

    Columns only one side has are null on the other.
    """
    unique = drop_duplicates_keep_first(new, key, order)
    return existing.unionByName(new_rows(existing, unique, key), allowMissingColumns=True)
