"""The star schema: one fact table and five dimensions.

Every builder is a projection over a staging frame, with one lookup join where
a dimension needs a port code. Names and column order of the tables are fixed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from keelstone.functions import dates, keys, text
from keelstone.functions.missing import column
from keelstone.operators.lookup import attach_port_codes


@dataclass(frozen=True)
class Table:
    """Where a table is written, by which column it is partitioned, and what must hold of it.

    keys:  each names one row of the table (NULL counts as a value).
    types: names and types, where they do not depend on the sources' own.
    """

    name: str
    folder: str
    partition_by: str
    keys: tuple[tuple[str, ...], ...] = ()
    types: Mapping[str, str] | None = None


# Table names, folders and partition columns of the star schema.
DATES = Table("D_DateTime", "D_DateTime_table_par", "ArriveYear")
FACT = Table("Fact_Immigrant", "Fact_Immigrant_table_par", "VisaType", (("cicid_Immigrant",),))
PERSONS = Table(
    "D_Immigrant_detail", "Immigrant_detail_table_par", "ArriveMode", (("cicid_Immigrant",),)
)
# A city or airport has a row for each of its ports.
CITIES = Table(
    "D_USCities", "D_USCities_table_par", "StateCode", (("CityName", "AirPortCode"),),
    dict(
        AirPortCode="string", CityName="string", StateCode="string", StateName="string",
        MedianAge="double", TotalPopulation="int", Veterans="int", ForeignBorn="int",
        AvgHouseholdSize="double", Race="string",
    ),
)
AIRPORTS = Table(
    "D_AirPort", "Airport_parquet", "Type", (("AirPortID", "AirportName", "AirPortCode"),),
    dict(
        AirPortCode="string", AirPortID="string", Type="string", AirportName="string",
        CityName="string", Elevation="int", Country="string", Coordinates="string",
    ),
)
TEMPERATURES = Table(
    "D_WorldTemp", "WorldTemp_parquet", "CityName", (("CityName", "AirPortCode"),),
    dict(
        AirPortCode="string", DateTime="date", AvgTemperature="double", CityName="string",
        Latitude="string", Longitude="string",
    ),
)

# Source columns each part of the schema reads.
ARRIVAL_COLUMNS = [
    "cicid", "i94cit", "i94res", "i94port", "arrdate", "depdate", "i94mode", "i94addr",
    "biryear", "gender", "fltno", "matflag", "visatype", "admnum",
]
CITY_COLUMNS = [
    "City", "State", "State Code", "Median Age", "Total Population", "Number of Veterans",
    "Foreign-born", "Average Household Size", "Race",
]
AIRPORT_COLUMNS = [
    "ident", "type", "name", "municipality", "elevation_ft", "iso_country", "coordinates",
]
REGION_COLUMN = "iso_region"
TEMPERATURE_COLUMNS = ["dt", "AverageTemperature", "City", "Latitude", "Longitude"]

# Types of the delimited sources; columns not named are text.
CITY_TYPES = {
    "Median Age": "double",
    "Total Population": "int",
    "Number of Veterans": "int",
    "Foreign-born": "int",
    "Average Household Size": "double",
}
AIRPORT_TYPES = {"elevation_ft": "int"}
TEMPERATURE_TYPES = {"dt": "date", "AverageTemperature": "double"}


def _project(df: DataFrame, **named: str | Column) -> DataFrame:
    return df.select(
        [(column(c) if isinstance(c, str) else c).alias(name) for name, c in named.items()]
    )


def arrival_dates(arrivals: DataFrame, distinct: bool = False) -> DataFrame:
    """Date dimension: one row per arrival, or one per pair of dates."""
    # The parts need the date itself; only the two dates are kept as text.
    arrived = dates.day_number_to_date(F.col("arrdate"))
    left = dates.day_number_to_iso(F.col("depdate"))
    parts = dates.date_parts(F.col("_arrived"), "Arrive")
    table = arrivals.select(arrived.alias("_arrived"), left.alias("DepartureDate")).select(
        F.col("_arrived").cast("string").alias("ArriveDate"), *parts, "DepartureDate"
    )
    return table.distinct() if distinct else table


def immigration_fact(arrivals: DataFrame, stable_id: bool = False) -> DataFrame:
    """Fact table. `stable_id` derives the surrogate key from cicid."""
    return _project(
        arrivals,
        Immig_Fact_ID=keys.hashed_id("cicid") if stable_id else keys.running_id(),
        cicid_Immigrant="cicid",
        AirPortCode="i94port",
        ArriveDate=dates.day_number_to_iso(F.col("arrdate")),
        DepartureDate=dates.day_number_to_iso(F.col("depdate")),
        FromResidence="i94res",
        VisaType="visatype",
        AdminNumber="admnum",
    )


def person_details(arrivals: DataFrame) -> DataFrame:
    """Person dimension; its DepartureDate stays the raw day number."""
    return _project(
        arrivals,
        cicid_Immigrant="cicid",
        Citizenship="i94cit",
        ArriveStateCode="i94addr",
        DepartureDate="depdate",
        ArriveMode="i94mode",
        BirthYear="biryear",
        Gender="gender",
        FlightNumber="fltno",
        MatchArriveDeparture="matflag",
    )


def us_cities(cities: DataFrame, ports: DataFrame, match_state: bool = False) -> DataFrame:
    """City dimension, port codes by upper-cased city, optionally also by state."""
    raised = cities.withColumn("City", F.upper("City"))
    state = column("State Code") if match_state else None
    return _project(
        attach_port_codes(raised, ports, F.col("City"), state),
        AirPortCode="AirPortCode",
        CityName="City",
        StateCode="State Code",
        StateName="State",
        MedianAge="Median Age",
        TotalPopulation="Total Population",
        Veterans="Number of Veterans",
        ForeignBorn="Foreign-born",
        AvgHouseholdSize="Average Household Size",
        Race="Race",
    )


def airports(airports: DataFrame, ports: DataFrame, match_state: bool = False) -> DataFrame:
    """Airport dimension, port codes by upper-cased municipality.

    Municipalities are matched world-wide. `match_state` also compares the
    state in iso_region, so that only airports in the US find a port.
    """
    raised = airports.withColumn("municipality", F.upper("municipality"))
    state = text.us_state(F.col(REGION_COLUMN)) if match_state else None
    return _project(
        attach_port_codes(raised, ports, F.col("municipality"), state),
        AirPortCode="AirPortCode",
        AirPortID="ident",
        Type="type",
        AirportName="name",
        CityName="municipality",
        Elevation="elevation_ft",
        Country="iso_country",
        Coordinates="coordinates",
    )


def world_temperatures(
    temperatures: DataFrame, ports: DataFrame, ignore_case: bool = False
) -> DataFrame:
    """Temperature dimension.

    City names are matched as they are written, which finds few ports since
    the dictionary is in upper case; `ignore_case` matches upper-cased names.
    """
    renamed = temperatures.withColumnRenamed("dt", "DateTime")
    city = F.upper("City") if ignore_case else F.col("City")
    return _project(
        attach_port_codes(renamed, ports, city),
        AirPortCode="AirPortCode",
        DateTime="DateTime",
        AvgTemperature="AverageTemperature",
        CityName="City",
        Latitude="Latitude",
        Longitude="Longitude",
    )
