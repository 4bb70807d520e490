"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tickloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a machine-local one only where none is set (local mode)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_scratch()


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="tickloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch folder, or under that of the run it is called in."""
    return f"{_run_folder.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


@contextmanager
def scratch_run(spark: SparkSession, otherwise: str) -> Iterator[None]:
    """What is staged inside is removed at the end. It lies in the cluster's shared folder, or
    below ``otherwise``, a folder that the executors are known to reach, where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or otherwise
    folder = f"{root.rstrip('/')}/run-{uuid.uuid4().hex}"
    token = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(token)
        remove(spark, folder)


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; nothing happens where there is none."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    files, at = _file_system(spark, path)
    return files.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; nothing where there is none."""
    files, at = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in files.listStatus(at)) if files.exists(at) else []


def move(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a folder; false where there is none."""
    files, at = _file_system(spark, path)
    return files.exists(at) and files.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many: cuts lineage so that later steps do not re-parse raw files,
    and a lost executor costs a re-read of the staged table rather than a recompute."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
