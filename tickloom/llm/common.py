"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import stage

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"

__all__ = ["SPACE", "apart", "importable", "stage", "table", "whole"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def importable(df: DataFrame) -> DataFrame:
    """The frame; from now on Python workers look for this package where the driver has it.

    That is needed where the driver was started from another folder and the package is not installed. A cluster
    without that folder gets the package as it does others (installed, or by --py-files).
    """
    environment = df.sparkSession.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df


def apart(taken: Iterable[str], *names: str) -> list[str]:
    """Column names that do not clash with those taken (Spark compares them without case)."""
    used, out = {x.lower() for x in taken}, []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out
