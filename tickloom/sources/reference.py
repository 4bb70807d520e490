"""Landed reference-data records: securities, splits, dividends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickloom.sources.raw import file_format


def read_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Records landed as JSON lines, CSV or Parquet (file or folder with that suffix).

    Without a schema, names come from the records and all values are read as text; the
    operators cast what they need.
    """
    if path.rstrip("/").endswith((".json", ".json.gz", ".jsonl")):
        reader = spark.read.option("primitivesAsString", "true")
        return (reader.schema(schema) if schema else reader).json(path)
    if file_format(path.rstrip("/")) == "parquet":
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    reader = spark.read.option("header", "true")
    return (reader.schema(schema) if schema else reader).csv(path)
