"""Parquet tables, written behind a row-count gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from keelstone.sinks.publish import TABLE, Gate, Publication, Written, split_path
from keelstone.sources.files import exists, read_parquet


def write_checked(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite",
    metrics: Mapping[str, Column] | None = None, gates: Sequence[Gate] = (), replace: str = TABLE,
) -> Written:
    """Write `df` beside `path`, read it back, compare the row counts, and swap it in.

    The table in use stays as it is until the new one has passed: a gate that
    fails or a run that dies costs nothing. `gates` are called with the table
    read back and raise what they find. With `replace="partitions"` only the
    partitions that `df` has rows of are replaced.

    Rows with one partition value are brought together, so a value gets a few
    files and not one per task; the exchange is a rebalance, which adaptive
    execution splits again for a value that holds too much for one task. Rows
    are counted in the writing stage itself, after that exchange, where each
    task counts once even if executors are lost. The count of the written
    table comes from the file footers.

    The table returned has the column order and types of `df`: partition
    values are read with the given schema instead of being guessed. An empty
    text as partition value comes back as NULL. `metrics` are aggregates of the written
    rows, taken in the same pass.
    """
    if mode not in ("overwrite", "error", "errorifexists"):
        raise ValueError(f"mode {mode} would mix the rows with those of another write")
    spark = df.sparkSession
    base, name = split_path(path)
    if mode != "overwrite" and exists(spark, path):
        raise FileExistsError(path)
    publication = Publication(spark, base, name)
    try:
        written = publication.write(df, name, partition_by, metrics, gates, replace)
    except Exception:
        publication.abandon()
        raise
    return written._replace(table=publication.commit()[name])


def write_new(df: DataFrame, path: str) -> DataFrame:
    """Unpartitioned write that refuses to touch an existing table."""
    df.write.mode("errorifexists").parquet(path)
    return read_parquet(df.sparkSession, path, df.schema)
