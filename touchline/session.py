"""Session settings and the shared folder for data that must outlive a task."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth an extra exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g", folder: str | None = None) -> SparkSession:
    """A single-machine session for tests and the bench; `folder` is where intermediate data goes."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("touchline")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    if folder is not None:
        builder = builder.config("spark.checkpoint.dir", folder)
    return tune(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, else the checkpoint folder of the context.

    It is never made up: a machine's own disk is lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(configured)
    return configured


#: Scratch paths and tables of this process, for `clear_scratch`.
_PATHS: list[str] = []
_TABLES: list[str] = []
#: Scratch paths of the scope at hand, if there is one.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")
    scope = _SCOPE.get()
    (_PATHS if scope is None else scope).append(path)
    return path


def _delete(spark: SparkSession, paths: list[str]) -> None:
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate data written so far. Frames that still read it become useless."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop()}")
    _delete(spark, _PATHS)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate data written inside, by this thread and those that run in its context, goes at the end."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        _delete(spark, paths)


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: the result is on shared storage, so a lost executor costs nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new table in the shared folder and read it back; scans of it prune columns."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Like `stored`, but hashed on `keys` into buckets, as many as a shuffle has partitions by default.

    A later join on `keys` then moves only its other side, however often it is repeated. `df` should
    come out of a grouping by `keys`, so that each bucket is written by one task.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, name)
    table = os.path.basename(path).replace("-", "_")
    _TABLES.append(table)
    df.write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)
