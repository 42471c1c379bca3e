"""Text expressions used for labels, lookup keys and column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# Stand-ins for a label that names no city.
UNKNOWN_CITY = "UnknownCity"
UNKNOWN_STATE = "UnknownState"

# Characters a column name may not keep; a blank becomes "_".
DROPPED_IN_NAMES = "(),;{}\n\t"


def strip(text: Column) -> Column:
    """Remove all leading and trailing white space, tabs and CR included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def unquote(text: Column) -> Column:
    return F.translate(text, "'", "")


def label_code(line: Column) -> Column:
    """Left side of a ``'code' = 'label'`` line; blanks inside the quotes belong to the code."""
    return unquote(strip(F.get(F.split(line, "=", 2), F.lit(0))))


def label_text(line: Column) -> Column:
    """All behind the first '=' of a ``'code' = 'label'`` line; NULL where there is none."""
    return strip(unquote(strip(F.get(F.split(line, "=", 2), F.lit(1)))))


def city_and_state(label: Column) -> tuple[Column, Column]:
    """Split 'CITY, ST[, more]'. A label without a comma names no city."""
    parts = F.split(label, ",")
    named = F.size(parts) >= 2
    city = F.when(named, strip(F.get(parts, F.lit(0)))).otherwise(F.lit(UNKNOWN_CITY))
    state = F.when(named, strip(F.get(parts, F.lit(1)))).otherwise(F.lit(UNKNOWN_STATE))
    return city, state


def us_state(region: Column) -> Column:
    """State of a 'US-XX' region; NULL for other countries."""
    return F.nullif(F.regexp_extract(region, "^US-(.+)$", 1), F.lit(""))


def starts_with_digit(text: Column) -> Column:
    return text.rlike("^[0-9]")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clean_name(name: str) -> str:
    return re.sub(f"[{re.escape(DROPPED_IN_NAMES)}]", "", name).replace(" ", "_")


def with_clean_names(df: DataFrame) -> DataFrame:
    """Rename all columns to names that Parquet and SQL take unquoted.

    Names that would become one and the same (also but for their case) are refused.
    """
    names: dict[str, list[str]] = {}
    for name in df.columns:
        names.setdefault(clean_name(name).lower(), []).append(name)
    clash = [old for old in names.values() if len(old) > 1]
    if clash or "" in names:
        raise ValueError(f"these columns would share a name or have none: {clash or names['']}")
    return df.toDF(*[clean_name(n) for n in df.columns])
