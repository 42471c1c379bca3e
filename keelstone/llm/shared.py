"""Staged tables in the folder all executors share, and column names that clash with none."""

from __future__ import annotations

from pyspark.sql import DataFrame

from keelstone import scratch


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` once in the shared folder and return the written table."""
    return scratch.stage(df, label, **options)


def repeated_ids(docs: DataFrame) -> bool:
    """Whether rows share a doc_id."""
    return not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def fresh(df: DataFrame, name: str) -> str:
    """`name`, or a longer one if `df` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
