"""Checks that stop a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from keelstone.functions.missing import column
from keelstone.operators import cleaning
from keelstone.operators.lookup import BROADCAST_ROWS, fits_broadcast


class DataQualityError(ValueError):
    """Data did not pass a gate."""


def check_row_counts(before: int, after: int) -> None:
    """Both counts must be positive and equal."""
    if not before or not after:
        raise DataQualityError(f"no rows: {before} before and {after} after the write")
    if before != after:
        raise DataQualityError(f"{before} rows before the write but {after} after it")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return cleaning.key_counts(df, keys).where(F.col("copies") > 1)


def check_unique(df: DataFrame, keys: Sequence[str]) -> None:
    worst = key_violations(df, keys).orderBy(F.desc("copies")).first()
    if worst is not None:
        raise DataQualityError(f"key {list(keys)} is not unique: {worst.asDict()}")


def orphans(
    child: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Keys of `child` that `parent` lacks, with their number of rows; a key with a NULL refers to nothing.

    The rows of a key are counted before anything is joined, so a key that many
    rows share is one row. Parents that are measured to fit are broadcast, and
    then only the orphans are shuffled; otherwise distinct keys meet in a
    shuffle join.
    """
    known = [f"_known_{i}" for i in range(len(keys))]
    there = parent.select(*[column(k).alias(n) for k, n in zip(parent_keys, known)]).distinct()
    named = reduce(lambda a, b: a & b, (column(k).isNotNull() for k in keys))
    on = reduce(lambda a, b: a & b, (column(k) == F.col(n) for k, n in zip(keys, known)))
    used = child.where(named).select(*[column(k) for k in keys])
    if fits_broadcast(there, broadcast_rows):
        return cleaning.key_counts(used.join(F.broadcast(there), on, "left_anti"), keys, "rows")
    return cleaning.key_counts(used, keys, "rows").join(there, on, "left_anti")


def check_references(
    child: DataFrame, keys: Sequence[str], parent: DataFrame, parent_keys: Sequence[str]
) -> None:
    """Every key of `child` must be one of `parent`."""
    worst = orphans(child, keys, parent, parent_keys).orderBy(F.desc("rows")).first()
    if worst is not None:
        raise DataQualityError(f"{list(keys)} refers to nothing: {worst.asDict()}")


def check_types(df: DataFrame, expected: StructType | Mapping[str, str]) -> None:
    """Names and types must be as expected, in any order."""
    found = dict(df.dtypes)
    if isinstance(expected, StructType):
        expected = {f.name: f.dataType.simpleString() for f in expected.fields}
    wanted = dict(expected)
    wrong = {n for n in found.keys() | wanted.keys() if found.get(n) != wanted.get(n)}
    if wrong:
        detail = {n: (wanted.get(n), found.get(n)) for n in sorted(wrong)}
        raise DataQualityError(f"columns differ from (expected, found): {detail}")
