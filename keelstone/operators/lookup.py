"""Look up port codes by city name.

The frame that keeps all its rows is the left side and the dictionary is the
right side of a left outer join, so a dictionary small enough can be broadcast
and the large frame never moves. Its size is measured, not assumed; a larger
one is joined by shuffle, where adaptive execution splits a city that holds
too many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from keelstone.functions.missing import column

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    return measure(df, max_rows, max_bytes)[1]


def measure(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> tuple[int, bool]:
    """Rows of a frame of flat columns, and whether rows and bytes fit a broadcast.

    A plain aggregate: every partition sends one row.
    """
    width = F.lit(8 * len(df.columns))
    for field in df.schema.fields:
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(column(field.name)), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows, rows <= max_rows and (size or 0) <= max_bytes


def attach_port_codes(
    df: DataFrame,
    ports: DataFrame,
    city: Column,
    state: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add AirPortCode to every row of `df`, NULL where no port matches.

    A city with several ports repeats the row, once per port. Names compare
    exactly; pass an upper-cased `city` to ignore case. With `state` both city
    and state have to match.
    """
    wanted = ports.select(
        F.col("PortCode").alias("AirPortCode"),
        F.col("CityName").alias("_port_city"),
        F.col("StateCode").alias("_port_state"),
    )
    same = city == F.col("_port_city")
    if state is not None:
        same = same & (state == F.col("_port_state"))
    if fits_broadcast(wanted, max_rows, max_bytes):
        wanted = F.broadcast(wanted)
    return df.join(wanted, same, "left").drop("_port_city", "_port_state")


def lookup_misses(df: DataFrame, code: str = "AirPortCode") -> DataFrame:
    """Rows in, and rows for which no code was found."""
    return df.select(
        F.count(F.lit(1)).alias("row_count"), F.count_if(column(code).isNull()).alias("misses")
    )
