"""Port-code lookups over the stand-in sources."""

from pyspark.sql import functions as F

from keelstone.operators.lookup import attach_port_codes, lookup_misses
from keelstone.plans import star
from suite.registry import query
from suite.standins import (
    AIRPORTS_SQL, CITIES_SQL, PORTS_SQL, TEMPERATURES_SQL, airports, cities, ports, temperatures,
)


def cities_sql(source, extra=""):
    return f"""
        SELECT port_code AS "AirPortCode", upper("City") AS "CityName",
               "State Code" AS "StateCode", "State" AS "StateName", "Median Age" AS "MedianAge",
               "Total Population" AS "TotalPopulation", "Number of Veterans" AS "Veterans",
               "Foreign-born" AS "ForeignBorn", "Average Household Size" AS "AvgHouseholdSize",
               "Race"
        FROM ({source}) AS s LEFT JOIN ({PORTS_SQL}) AS p ON upper("City") = port_city {extra}
    """


def airports_sql(source, extra=""):
    return f"""
        SELECT port_code AS "AirPortCode", ident AS "AirPortID", type AS "Type",
               name AS "AirportName", upper(municipality) AS "CityName",
               elevation_ft AS "Elevation", iso_country AS "Country",
               coordinates AS "Coordinates"
        FROM ({source}) AS s LEFT JOIN ({PORTS_SQL}) AS p ON upper(municipality) = port_city
            {extra}
    """


def temperatures_sql(source, city='"City"'):
    return f"""
        SELECT port_code AS "AirPortCode", dt AS "DateTime",
               "AverageTemperature" AS "AvgTemperature", "City" AS "CityName", "Latitude",
               "Longitude"
        FROM ({source}) AS s LEFT JOIN ({PORTS_SQL}) AS p ON {city} = port_city
    """


@query(cities_sql(CITIES_SQL))
def lookup_upper_fanout(spark, folder):
    return star.us_cities(cities(spark, folder), ports(spark, folder))


@query(airports_sql(AIRPORTS_SQL))
def lookup_airports(spark, folder):
    return star.airports(airports(spark, folder), ports(spark, folder))


@query(temperatures_sql(TEMPERATURES_SQL))
def lookup_case_sensitive(spark, folder):
    return star.world_temperatures(temperatures(spark, folder), ports(spark, folder))


@query(temperatures_sql(TEMPERATURES_SQL, 'upper("City")'))
def lookup_ignore_case(spark, folder):
    return star.world_temperatures(
        temperatures(spark, folder), ports(spark, folder), ignore_case=True
    )


@query(cities_sql(CITIES_SQL, 'AND "State Code" = port_state'))
def lookup_two_keys(spark, folder):
    return star.us_cities(cities(spark, folder), ports(spark, folder), match_state=True)


@query(airports_sql(AIRPORTS_SQL, "AND iso_region = 'US-' || port_state"))
def lookup_airports_two_keys(spark, folder):
    return star.airports(airports(spark, folder), ports(spark, folder), match_state=True)


@query(
    f"""
    SELECT count(*) AS row_count, count(*) FILTER ("AirPortCode" IS NULL) AS misses
    FROM ({cities_sql(CITIES_SQL)})
    """
)
def lookup_miss_count(spark, folder):
    return lookup_misses(star.us_cities(cities(spark, folder), ports(spark, folder)))


# The form used when the dictionary is too large to broadcast.
@query(
    f"""
    SELECT s.*, port_code AS "AirPortCode"
    FROM ({AIRPORTS_SQL}) AS s LEFT JOIN ({PORTS_SQL}) AS p ON upper(municipality) = port_city
    """
)
def lookup_large_dictionary(spark, folder):
    return attach_port_codes(
        airports(spark, folder), ports(spark, folder), F.upper("municipality"), max_rows=0
    )
