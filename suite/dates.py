"""Dates held as day numbers, date dimension, projections, surrogate keys."""

from pyspark.sql import functions as F

from keelstone.functions import dates, keys, text
from keelstone.plans import star
from suite.registry import query, table
from suite.standins import ARRIVALS_SQL, arrivals

_ISO = "CASE WHEN {0} <> 0 THEN strftime(DATE '1960-01-01' + CAST(floor({0}) AS INTEGER), '%Y-%m-%d') END"
_DATE = "CASE WHEN arrdate <> 0 THEN DATE '1960-01-01' + CAST(floor(arrdate) AS INTEGER) END"

DATES_SQL = f"""
    SELECT CAST(day AS VARCHAR) AS "ArriveDate",
           CAST(year(day) AS INTEGER) AS "ArriveYear",
           CAST(month(day) AS INTEGER) AS "ArriveMonth",
           CAST(day(day) AS INTEGER) AS "ArriveDay",
           dayname(day) AS "Arrive_DayOfWeek", "DepartureDate"
    FROM (SELECT {_DATE} AS day, {_ISO.format('depdate')} AS "DepartureDate"
          FROM ({ARRIVALS_SQL}))
"""


def fact_sql(source):
    return f"""
        SELECT cicid AS "cicid_Immigrant", i94port AS "AirPortCode",
               {_ISO.format('arrdate')} AS "ArriveDate",
               {_ISO.format('depdate')} AS "DepartureDate",
               i94res AS "FromResidence", visatype AS "VisaType", admnum AS "AdminNumber"
        FROM ({source})
    """


def person_sql(source):
    return f"""
        SELECT cicid AS "cicid_Immigrant", i94cit AS "Citizenship", i94addr AS "ArriveStateCode",
               depdate AS "DepartureDate", i94mode AS "ArriveMode", biryear AS "BirthYear",
               gender AS "Gender", fltno AS "FlightNumber", matflag AS "MatchArriveDeparture"
        FROM ({source})
    """


@query(
    f"""
    SELECT cicid, i94port, {_ISO.format('arrdate')} AS arrived, {_ISO.format('depdate')} AS departed
    FROM ({ARRIVALS_SQL})
    """
)
def sas_date_iso(spark, folder):
    return arrivals(spark, folder).select(
        "cicid",
        "i94port",
        dates.day_number_to_iso(F.col("arrdate")).alias("arrived"),
        dates.day_number_to_iso(F.col("depdate")).alias("departed"),
    )


@query(DATES_SQL)
def date_dimension(spark, folder):
    return star.arrival_dates(arrivals(spark, folder))


@query(f"SELECT DISTINCT * FROM ({DATES_SQL})")
def date_dimension_distinct(spark, folder):
    return star.arrival_dates(arrivals(spark, folder), distinct=True)


@query(fact_sql(ARRIVALS_SQL))
def fact_projection(spark, folder):
    return star.immigration_fact(arrivals(spark, folder)).drop("Immig_Fact_ID")


@query(person_sql(ARRIVALS_SQL))
def dim_projection(spark, folder):
    return star.person_details(arrivals(spark, folder))


@query(
    """
    SELECT c_custkey AS "key_of_customer", c_name AS "name", c_acctbal AS "balance_USD_"
    FROM customer
    """
)
def sanitize_columns(spark, folder):
    odd = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key of customer\t"),
        F.col("c_name").alias("{name;}\n"),
        F.col("c_acctbal").alias("balance (USD) ,"),
    )
    return text.with_clean_names(odd)


@query("SELECT count(*) AS row_count, count(*) AS id_count FROM lineitem")
def surrogate_id_check(spark, folder):
    ids = table(spark, folder, "lineitem").select(keys.running_id().alias("id"))
    return ids.select(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("id_count")
    )


@query(
    """
    SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS id_count
    FROM lineitem
    """
)
def surrogate_hash_check(spark, folder):
    ids = table(spark, folder, "lineitem").select(
        keys.hashed_id("l_orderkey", "l_linenumber").alias("id")
    )
    return ids.select(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("id").alias("id_count")
    )


@query(
    """
    SELECT p_partkey, p_brand,
           row_number() OVER (ORDER BY p_brand NULLS FIRST, p_partkey NULLS FIRST) - 1 AS id
    FROM part
    """
)
def dense_ids(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_brand")
    return keys.with_dense_id(part, ["p_brand", "p_partkey"], "id", partitions=7)


@query("SELECT p_partkey, p_brand FROM part WHERE regexp_matches(substr(p_brand, 7), '^[0-9]')")
def first_char_digit(spark, folder):
    part = table(spark, folder, "part")
    return part.where(text.starts_with_digit(F.substr("p_brand", F.lit(7)))).select(
        "p_partkey", "p_brand"
    )
