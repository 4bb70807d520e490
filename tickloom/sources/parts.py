"""Derived tables that are rebuilt in parts and switched at once.

Layout below ``<table>_parts``::

    rows-<stamp>/part=N/    the partitions that one build wrote, dealt by symbol
    state-<stamp>/          one build: which folder holds each partition, which event files it
                            has seen, and the dates it covers

The newest finished state is the table. Spark writes its mark of success last, so a reader
sees the state before a build or the one after it, never a table that is absent or in part.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import date
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tickloom.session import children, exists, remove

if TYPE_CHECKING:
    from tickloom.sources.lake import Lake

_STATE = "kind string, part int, value string"


def parts_name(name: str) -> str:
    return f"{name}_parts"


@dataclass(frozen=True)
class State:
    """One build of a table: folder by partition, event files seen, and its dates."""

    folders: dict[int, str]
    sources: frozenset[str] = frozenset()
    start: date | None = None
    end: date | None = None


def states(lake: Lake, name: str) -> list[str]:
    """Folders of the finished builds, oldest first."""
    root = lake.path(parts_name(name))
    return [
        folder for folder in children(lake.spark, root)
        if folder.startswith("state-") and exists(lake.spark, f"{root}/{folder}/_SUCCESS")
    ]


def read_state(lake: Lake, name: str, folder: str) -> State:
    """A build's state: at most one row a partition, and one an event file."""
    stored = lake.spark.read.schema(_STATE).parquet(lake.path(parts_name(name), folder)).collect()
    of = {kind: [r for r in stored if r.kind == kind] for kind in ("part", "source", "start", "end")}
    dates = [next((date.fromisoformat(r.value) for r in of[k]), None) for k in ("start", "end")]
    sources = frozenset(r.value for r in of["source"])
    return State({r.part: r.value for r in of["part"]}, sources, *dates)


def latest_state(lake: Lake, name: str) -> State | None:
    """State of the newest finished build; None where there is none."""
    done = states(lake, name)
    return read_state(lake, name, done[-1]) if done else None


def read_parts(
    lake: Lake, name: str, schema: T.StructType, state: State, parts: list[int] | None = None
) -> DataFrame:
    """Rows of a build, of all its partitions or of some."""
    held = [p for p in sorted(state.folders) if parts is None or p in parts]
    paths = [lake.path(parts_name(name), state.folders[p], f"part={p}") for p in held]
    if not paths:
        return lake.spark.createDataFrame([], schema)
    return lake.spark.read.schema(schema).parquet(*paths)


def new_folder(kind: str) -> str:
    """A name that sorts after those given before."""
    return f"{kind}-{time.time_ns():020d}-{uuid.uuid4().hex}"


def publish(lake: Lake, name: str, state: State) -> None:
    """Make a build the table, and remove what only builds before the last two hold.

    The build before stays, for readers that have just looked it up. Folders that no state
    names are left alone: another build may be writing them.
    """
    rows = [("part", p, folder) for p, folder in state.folders.items()]
    rows += [("source", None, file) for file in state.sources]
    dates = (("start", state.start), ("end", state.end))
    rows += [(kind, None, day.isoformat()) for kind, day in dates if day is not None]
    root = lake.path(parts_name(name))
    frame = lake.spark.createDataFrame(rows, _STATE).coalesce(1)
    frame.write.parquet(f"{root}/{new_folder('state')}")
    *past, before, now = [None, *states(lake, name)]
    kept = [read_state(lake, name, folder).folders for folder in (before, now) if folder]
    for folder in past:
        if folder is None:
            continue
        for part, rows_folder in read_state(lake, name, folder).folders.items():
            if all(held.get(part) != rows_folder for held in kept):
                remove(lake.spark, f"{root}/{rows_folder}/part={part}")
        remove(lake.spark, f"{root}/{folder}")
