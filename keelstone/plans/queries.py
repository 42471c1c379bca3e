"""Analytic queries over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from keelstone import scratch
from keelstone.functions.missing import column
from keelstone.operators import skew
from keelstone.operators.lookup import fits_broadcast

# View names.
FACT_VIEW = "Fact_Imm"
PERSON_VIEW = "D_Imm"
CITY_VIEW = "UsCities"

COUNT_NAME = "count_F_Immg"

# Arrivals per ForeignBorn value of the port's city. Counting join partners
# needs no joined rows, only their numbers, so both large inputs are reduced
# to counts before they meet: a port or person with a large share of the rows
# is collapsed before any shuffle.
_ARRIVALS_SQL = f"""
WITH visits AS (
    SELECT cicid_Immigrant, AirPortCode, count(*) AS n FROM {FACT_VIEW}
    WHERE AirPortCode IS NOT NULL GROUP BY cicid_Immigrant, AirPortCode
), persons AS (
    SELECT cicid_Immigrant, count(*) AS n FROM {PERSON_VIEW} GROUP BY cicid_Immigrant
), per_port AS (
    SELECT AirPortCode, sum(visits.n * persons.n) AS n
    FROM visits JOIN persons ON visits.cicid_Immigrant = persons.cicid_Immigrant
    GROUP BY AirPortCode
), places AS (
    SELECT AirPortCode, ForeignBorn, count(*) AS n FROM {CITY_VIEW}
    GROUP BY AirPortCode, ForeignBorn
)
SELECT places.ForeignBorn, sum(per_port.n * places.n) AS {COUNT_NAME}
FROM per_port JOIN places ON per_port.AirPortCode = places.AirPortCode
GROUP BY places.ForeignBorn
"""


def register_views(fact: DataFrame, persons: DataFrame, cities: DataFrame) -> None:
    fact.createOrReplaceTempView(FACT_VIEW)
    persons.createOrReplaceTempView(PERSON_VIEW)
    cities.createOrReplaceTempView(CITY_VIEW)


def arrivals_by_foreign_born_sql(spark: SparkSession, with_key: bool = False) -> DataFrame:
    """Spark SQL over the registered views; see `arrivals_by_foreign_born`."""
    keys = "ForeignBorn, " if with_key else ""
    return spark.sql(
        f"SELECT {keys}{COUNT_NAME} FROM ({_ARRIVALS_SQL}) ORDER BY {COUNT_NAME} DESC"
    )


def arrivals_by_foreign_born(
    fact: DataFrame,
    persons: DataFrame,
    cities: DataFrame,
    with_key: bool = False,
    unique_persons: bool = False,
) -> DataFrame:
    """Count arrivals whose person and port city are known, per ForeignBorn.

    Cities sharing a ForeignBorn value (or lacking one) form one group. The
    group value itself is only part of the result with `with_key`. Largest
    count first. With `unique_persons` (cicid proven unique in both frames)
    the count per person is skipped, which saves a shuffle of the fact keys.
    """
    arrived = fact.where(F.col("AirPortCode").isNotNull()).select(
        "cicid_Immigrant", "AirPortCode"
    )
    one = F.count(F.lit(1))
    if unique_persons:
        per_port = (
            arrived.join(persons.select("cicid_Immigrant"), "cicid_Immigrant")
            .groupBy("AirPortCode").agg(one.alias("n"))
        )
    else:
        visits = arrived.groupBy("cicid_Immigrant", "AirPortCode").agg(one.alias("visits"))
        known = persons.groupBy("cicid_Immigrant").agg(one.alias("persons"))
        per_port = (
            visits.join(known, "cicid_Immigrant")
            .groupBy("AirPortCode").agg(F.sum(F.col("visits") * F.col("persons")).alias("n"))
        )
    places = cities.groupBy("AirPortCode", "ForeignBorn").agg(one.alias("cities"))
    counts = (
        per_port.join(places, "AirPortCode")
        .groupBy("ForeignBorn").agg(F.sum(F.col("n") * F.col("cities")).alias(COUNT_NAME))
    )
    shown = ["ForeignBorn", COUNT_NAME] if with_key else [COUNT_NAME]
    return counts.select(*shown).orderBy(F.desc(COUNT_NAME))


def arrival_details(
    fact: DataFrame, persons: DataFrame, cities: DataFrame, heavy_rows: int = skew.HEAVY_ROWS
) -> DataFrame:
    """Rows of the fact joined to its city by port and to its person by cicid.

    Repeated names are told apart: the person's DepartureDate (a day number)
    comes as PersonDepartureDate, the keys come once. A city table small enough
    by measure is broadcast; all other joins spread a key that holds too many rows
    over as many tasks as it needs (`skew.inner_join`).
    """
    people = persons.withColumnRenamed("DepartureDate", "PersonDepartureDate")
    known = skew.inner_join(fact, people, ["cicid_Immigrant"], heavy_rows)
    if fits_broadcast(cities):
        return known.join(F.broadcast(cities), "AirPortCode")
    return skew.inner_join(scratch.stage(known, "known-arrivals"), cities, ["AirPortCode"], heavy_rows)


def count_by_period(df: DataFrame, key: str, date: str, monthly: bool = True) -> DataFrame:
    """Rows per key and year, or per key, year and month, of a date column."""
    periods = [F.year(column(date)).alias("year")]
    if monthly:
        periods.append(F.month(column(date)).alias("month"))
    return df.groupBy(column(key), *periods).agg(F.count(F.lit(1)).alias("row_count"))


def count_levels(df: DataFrame, levels: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Rows per group on several levels, from one pass over the rows.

    A level lists those of `names` that it groups by; an empty one is the total.
    Columns that a level does not have are NULL in its rows, and `level` (the
    place in `levels`) tells them from groups whose value is NULL.
    """
    names, chosen = list(names), [tuple(level) for level in levels]
    unknown = {n for level in chosen for n in level} - set(names)
    if unknown or len({frozenset(level) for level in chosen}) < len(chosen):
        raise ValueError(f"levels must differ and use {names}")
    columns = [column(n) for n in names]
    counts = df.groupingSets([[column(n) for n in level] for level in chosen], *columns).agg(
        F.count(F.lit(1)).alias("row_count"), F.grouping_id(*columns).alias("_without")
    )
    # The first column is the highest bit; it is set where the column is left out.
    bits = {n: 1 << i for i, n in enumerate(reversed(names))}
    level_of = F.create_map(*[
        F.lit(x) for i, level in enumerate(chosen) for x in (sum(b for n, b in bits.items() if n not in level), i)
    ])
    return counts.select(level_of[F.col("_without").cast("int")].alias("level"), *columns, "row_count")


def largest_groups(df: DataFrame, key: str, k: int, count_name: str = "row_count") -> DataFrame:
    """The k keys with most rows; equal counts in key order."""
    counts = df.groupBy(column(key)).agg(F.count(F.lit(1)).alias(count_name))
    return counts.orderBy(F.desc(count_name), column(key)).limit(k)


def preview(df: DataFrame, k: int, *order: str) -> DataFrame:
    """A few rows to look at; the first ones if an order is given."""
    return (df.orderBy(*[column(c) for c in order]) if order else df).limit(k)
