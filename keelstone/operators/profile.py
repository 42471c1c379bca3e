"""Counts that describe a frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from keelstone.functions import keys
from keelstone.functions.missing import any_missing, column, is_missing
from keelstone.operators import skew


def _rows() -> Column:
    return F.count(F.lit(1))


def missing_profile(
    df: DataFrame, columns: Sequence[str] | None = None, text_nan: bool = False
) -> DataFrame:
    """One row: the number of missing values of each column, under its name."""
    return df.select(
        [F.count_if(is_missing(df, n, text_nan)).alias(n) for n in columns or df.columns]
    )


def present_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of non-NULL values of each column."""
    return df.select([F.count(column(n)).alias(n) for n in columns or df.columns])


def missing_in(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.count_if(is_missing(df, name)).alias("missing"))


def dropped_by_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Rows in, and how many of them dropping missing values would remove."""
    return df.select(
        _rows().alias("rows_in"), F.count_if(any_missing(df, subset)).alias("rows_dropped")
    )


# Keys of so many columns or fewer are shuffled as they are.
NARROW_COLUMNS = 2


def repeated_groups(df: DataFrame, columns: Sequence[str] | None = None, **options) -> DataFrame:
    """Keys that occur more than once, with `_n` copies.

    Wide keys are counted by 128-bit fingerprints first, which is all that is
    shuffled of the rows that occur once; the full keys of the others are then
    compared, so the result is exact.
    """
    names = list(columns or df.columns)
    return _exact(_candidates(df, names, **options), names).where(F.col("_n") > 1)


def _exact(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.groupBy(*[column(c) for c in names]).agg(_rows().alias("_n"))


def _fingerprint_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys.fingerprint(names)).agg(_rows().alias("_n"))


def _candidates(df: DataFrame, names: Sequence[str], **options) -> DataFrame:
    """The rows that may occur more than once."""
    if len(names) <= NARROW_COLUMNS:
        return df
    marks = ["_fp_0", "_fp_1"]
    repeated = _fingerprint_counts(df, names).where(F.col("_n") > 1)
    marked = df.select("*", *keys.fingerprint(names))
    return skew.semi_join(marked, repeated, marks, "_n", **options).drop(*marks)


def repeated_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How many rows belong to groups that occur more than once."""
    return repeated_groups(df, columns).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in_groups"))


def surplus_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct keys and the rows beyond the first of each key."""
    names = list(columns or df.columns)
    if len(names) <= NARROW_COLUMNS:
        groups = _exact(df, names)
    else:
        # Fingerprints that occur once are keys of their own; the keys of the others are compared.
        once = _fingerprint_counts(df, names).where(F.col("_n") == 1).select("_n")
        groups = once.union(_exact(_candidates(df, names), names).select("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), _rows().alias("key_count")
    ).withColumn("surplus", F.col("row_count") - F.col("key_count"))


# How values of a type are compared: as a long, a double or a text.
_WHOLE = {"tinyint", "smallint", "int", "bigint", "boolean", "date"}
_FLOATING = {"float", "double"}


def _as(kind: str, value: Column) -> tuple[Column, Column, Column] | None:
    """A value as one of (long, double, text), distinct where it is; None if its type is not known."""
    none = F.lit(None)
    if kind == "date":
        value, kind = F.unix_date(value), "int"
    if kind == "timestamp":
        value, kind = F.unix_micros(value), "bigint"
    if kind in _WHOLE:
        return value.cast("long"), none.cast("double"), none.cast("string")
    if kind in _FLOATING:
        return none.cast("long"), value.cast("double"), none.cast("string")
    if kind in ("string", "timestamp_ntz") or kind.startswith(("decimal", "char", "varchar")):
        return none.cast("long"), none.cast("double"), value.cast("string")
    if kind == "binary":
        return none.cast("long"), none.cast("double"), F.hex(value)
    return None


def _facts_of_all(df: DataFrame, names: Sequence[str], kinds: Mapping[str, str]) -> DataFrame:
    """Facts about all columns from one scan: every row becomes a row per column.

    Equal values of a column are counted before anything is shuffled, so a
    column of few values is a few rows per task, and a hot value one.
    """
    cells = [
        F.struct(
            F.lit(i).alias("at"), is_missing(df, n).alias("gap"),
            *[x.alias(as_) for x, as_ in zip(_as(kinds[n], column(n)), ("whole", "number", "text"))],
        )
        for i, n in enumerate(names)
    ]
    values = df.select(F.inline(F.array(*cells)))
    counts = values.groupBy("at", "gap", "whole", "number", "text").agg(_rows().alias("n"))
    there = F.col("whole").isNotNull() | F.col("number").isNotNull() | F.col("text").isNotNull()
    total = lambda keep: F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0))
    found = counts.groupBy("at").agg(
        total(F.col("gap")).alias("missing"), total(there).alias("present"),
        F.count_if(there).alias("distinct_values"),
    )
    named = df.sparkSession.createDataFrame(
        [(i, n, kinds[n]) for i, n in enumerate(names)], "at int, column_name string, column_type string"
    )
    counted = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("missing", "present", "distinct_values")]
    # A table without rows still has its columns.
    return named.join(found, "at", "left").select("column_name", "column_type", *counted)


def _column_facts(df: DataFrame, name: str) -> DataFrame:
    """One row about one column, from the counts of its values."""
    kind = df.schema[name].dataType.simpleString()
    value = column(name)
    counts = df.groupBy(value.alias("value")).agg(
        _rows().alias("n"), F.first(is_missing(df, name)).alias("gap")
    )
    total = lambda keep: F.coalesce(F.sum(F.when(keep, F.col("n"))), F.lit(0))
    return counts.select(
        F.lit(name).alias("column_name"),
        F.lit(kind).alias("column_type"),
        total(F.col("gap")).alias("missing"),
        total(F.col("value").isNotNull()).alias("present"),
        F.count("value").alias("distinct_values"),
    )


def exploration_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, missing, present and distinct values.

    The frame is read once for all columns, so it may be a delimited source or a
    computed frame. Only columns of nested types are counted one by one.
    """
    names = list(columns or df.columns)
    kinds = {n: df.schema[n].dataType.simpleString() for n in names}
    plain = [n for n in names if _as(kinds[n], column(n)) is not None]
    parts = [_facts_of_all(df, plain, kinds)] if plain else []
    return reduce(DataFrame.union, parts + [_column_facts(df, n) for n in names if n not in plain])


def surplus_per_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: each column's non-NULL values beyond the first of each kind."""
    names = list(columns or df.columns)
    surplus = F.col("present") - F.col("distinct_values")
    return exploration_report(df, names).agg(
        *[F.max(F.when(F.col("column_name") == n, surplus)).alias(n) for n in names]
    )
