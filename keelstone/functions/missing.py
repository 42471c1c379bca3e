"""Type-aware tests for missing values.

NULL is missing for every type. NaN is missing as well, but only float and
double columns can hold it; calling `isnan` on text, dates or booleans is an
error under ANSI rules, so the test is chosen from the schema.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType


def column(name: str) -> Column:
    """Reference a column whose name may hold dots, blanks or dashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str, text_nan: bool = False) -> Column:
    """True where `name` is NULL or NaN; never NULL itself.

    With `text_nan` the text NaN in a string column counts too.
    """
    kind = df.schema[name].dataType
    value = column(name)
    if isinstance(kind, (FloatType, DoubleType)):
        return value.isNull() | F.isnan(value)
    if text_nan and isinstance(kind, StringType):
        return value.isNull() | F.coalesce(F.isnan(value.try_cast("double")), F.lit(False))
    return value.isNull()


def any_missing(df: DataFrame, names: Iterable[str]) -> Column:
    """True where at least one of `names` is missing; False for no names."""
    return reduce(lambda a, b: a | b, (is_missing(df, n) for n in names), F.lit(False))


def known(df: DataFrame, name: str) -> Column:
    """The value, with every kind of missing turned into NULL."""
    return F.when(~is_missing(df, name), column(name))
