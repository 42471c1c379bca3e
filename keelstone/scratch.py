"""Shared scratch space for staged tables and checkpoints.

A staged table must be readable by every executor and must outlive any of
them, so it goes to the folder named by ``spark.checkpoint.dir``. Only a local
session, whose single machine is also the driver, may fall back to a fresh
temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="keelstone-")
    return _local_roots[context.applicationId]


def _own_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/keelstone/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared root that nothing has used before."""
    return f"{_own_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` once as Parquet, with the writer's `options`, and return the written table.

    Use it where several later jobs need the same expensive frame: the
    lineage ends at the files, so a lost executor costs a re-read and not a
    recomputation, and all readers see the same rows.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with _shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _folders[table] = path
    return table


# Where staged tables lie, as long as somebody holds them.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def drop(*tables: DataFrame) -> None:
    """Delete staged tables that no later job reads, so that they take no disk until the end."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(_folders.pop(table))
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


# Removes the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing, _before = Lock(), 0, None


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Nobody reads the shuffles behind a table once it is written, so their disk is free again.

    Without this they stay until the driver happens to collect its garbage.
    Jobs of several threads share the setting; the last one to end puts it back.
    """
    global _writing, _before
    with _lock:
        if _writing == 0:
            _before = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writing += 1
    try:
        yield
    finally:
        with _lock:
            _writing -= 1
            if _writing == 0:
                spark.conf.unset(_CLEANUP) if _before is None else spark.conf.set(_CLEANUP, _before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable (never local) checkpoint of `df` in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> bool:
    """Delete the tables this application staged, once results are consumed.

    Checkpoints stay: Spark owns them and removes them by its cleaner settings.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_own_root(spark))
    return path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
