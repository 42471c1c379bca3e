"""Star-schema sources derived from the test tables, in Spark and in SQL.

Arrivals come from lineitem, ports from supplier, cities from customer,
airports from part and temperatures from orders. Missing values and duplicate
keys are made from the values of the rows.
"""

from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.functions.dates import date_to_day_number
from keelstone.sources import labels
from suite.registry import table

# --- label dictionary: two ports per town, some labels without a state -------

PORT_LINES_SQL = """
    SELECT '   ''P' || s_suppkey || '''' || chr(9) || '=' || chr(9) || '''TOWN '
        || CAST(floor(s_suppkey / 2) AS BIGINT)
        || CASE WHEN s_acctbal < 1000 THEN ' HARBOUR'
                WHEN s_acctbal > 9000 THEN ', S' || s_nationkey || ', Far'
                ELSE ', S' || s_nationkey END || '     ''' AS line
    FROM supplier
"""


def port_lines(spark, folder):
    balance = F.col("s_acctbal")
    state = F.concat(F.lit(", S"), F.col("s_nationkey"))
    ending = (
        F.when(balance < 1000, F.lit(" HARBOUR"))
        .when(balance > 9000, F.concat(state, F.lit(", Far")))
        .otherwise(state)
    )
    town = F.floor(F.col("s_suppkey") / 2)
    return table(spark, folder, "supplier").select(
        F.format_string("   'P%d'\t=\t'TOWN %d%s     '", "s_suppkey", town, ending).alias("line")
    )


ENTRIES_PER_SECTION = 200


def _sections(lines, key, head):
    """Text blocks of whole sections, each with a bounded number of entries."""
    listed = F.array_sort(F.collect_list("line"))
    text = F.concat_ws("\r\n", F.lit(head), listed, F.lit(";"), F.lit(""))
    block = F.floor(key / ENTRIES_PER_SECTION)
    return lines.groupBy(block.alias("block")).agg(text.alias("value")).select("value")


def write_label_file(spark, folder):
    """Label files with a port section from supplier, a country section from part."""
    path = scratch.new_folder(spark, "labels")
    ports = port_lines(spark, folder).withColumn(
        "key", F.regexp_extract("line", "'P([0-9]+)'", 1).cast("long")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"),
        F.format_string("   %d =  '%s'", "p_partkey", "p_name").alias("line"),
    )
    port_part = _sections(ports, F.col("key"), f"  value ${labels.PORT_SECTION}")
    other_part = _sections(
        parts, F.col("key"), f"/* codes; see below */\r\n  value {labels.COUNTRY_SECTION}"
    )
    port_part.union(other_part).write.text(path)
    return path


def ports(spark, folder):
    return labels.to_ports(labels.entries(port_lines(spark, folder)))


PORTS_SQL = """
    SELECT 'P' || s_suppkey AS port_code,
           CASE WHEN s_acctbal < 1000 THEN 'UnknownCity'
                ELSE 'TOWN ' || CAST(floor(s_suppkey / 2) AS BIGINT) END AS port_city,
           CASE WHEN s_acctbal < 1000 THEN 'UnknownState' ELSE 'S' || s_nationkey END AS port_state
    FROM supplier
"""

# --- arrivals ---------------------------------------------------------------

ARRIVALS_SQL = """
    SELECT CAST(l_orderkey AS DOUBLE) AS cicid,
           CASE WHEN l_tax = 0.08 THEN NULL WHEN l_tax = 0.07 THEN 'NaN'::DOUBLE
                ELSE CAST(l_partkey AS DOUBLE) END AS i94cit,
           CAST(l_suppkey AS DOUBLE) AS i94res,
           'P' || l_suppkey AS i94port,
           day + CASE WHEN l_quantity > 25 THEN 0.5 ELSE 0 END AS arrdate,
           CASE WHEN l_discount = 0 THEN NULL WHEN l_discount = 0.01 THEN 0
                ELSE day + l_quantity END AS depdate,
           CAST(l_linenumber AS DOUBLE) AS i94mode,
           l_linestatus AS i94addr,
           1900 + l_quantity AS biryear,
           NULLIF(l_returnflag, 'N') AS gender,
           CASE WHEN l_tax = 0 THEN NULL ELSE 'F' || l_partkey END AS fltno,
           NULLIF(l_linestatus, 'O') AS matflag,
           l_returnflag || l_linestatus AS visatype,
           l_extendedprice AS admnum
    FROM (SELECT *, CAST(CAST(l_shipdate AS DATE) - DATE '1960-01-01' AS DOUBLE) AS day
          FROM lineitem)
"""


def arrivals(spark, folder):
    day = date_to_day_number(F.col("l_shipdate").cast("date"))
    tax, discount, quantity = F.col("l_tax"), F.col("l_discount"), F.col("l_quantity")
    missing = F.lit(None).cast("double")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("double").alias("cicid"),
        F.when(tax == 0.08, missing).when(tax == 0.07, F.lit(float("nan")))
        .otherwise(F.col("l_partkey").cast("double")).alias("i94cit"),
        F.col("l_suppkey").cast("double").alias("i94res"),
        F.concat(F.lit("P"), "l_suppkey").alias("i94port"),
        (day + F.when(quantity > 25, 0.5).otherwise(0.0)).alias("arrdate"),
        F.when(discount == 0, missing).when(discount == 0.01, 0.0)
        .otherwise(day + quantity).alias("depdate"),
        F.col("l_linenumber").cast("double").alias("i94mode"),
        F.col("l_linestatus").alias("i94addr"),
        (1900 + quantity).alias("biryear"),
        F.nullif("l_returnflag", F.lit("N")).alias("gender"),
        F.when(tax != 0, F.concat(F.lit("F"), "l_partkey")).alias("fltno"),
        F.nullif("l_linestatus", F.lit("O")).alias("matflag"),
        F.concat("l_returnflag", "l_linestatus").alias("visatype"),
        F.col("l_extendedprice").alias("admnum"),
    )


# --- cities, airports, temperatures -----------------------------------------

CITIES_SQL = """
    SELECT 'Town ' || CAST(floor(c_custkey / 20) AS BIGINT) AS "City",
           c_mktsegment AS "State", 'S' || c_nationkey AS "State Code",
           c_acctbal AS "Median Age",
           CAST(c_custkey * 10 AS INTEGER) AS "Total Population",
           CASE WHEN c_acctbal >= 500 THEN CAST(floor(c_acctbal) AS INTEGER) END
               AS "Number of Veterans",
           CASE WHEN c_nationkey <> 7 THEN CAST(c_nationkey * 100 AS INTEGER) END
               AS "Foreign-born",
           CAST(c_nationkey AS DOUBLE) AS "Average Household Size", c_mktsegment AS "Race"
    FROM customer
"""


def cities(spark, folder):
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        F.format_string("Town %d", F.floor(F.col("c_custkey") / 20)).alias("City"),
        segment.alias("State"),
        F.concat(F.lit("S"), nation).alias("State Code"),
        balance.alias("Median Age"),
        (F.col("c_custkey") * 10).cast("int").alias("Total Population"),
        F.when(balance >= 500, F.floor(balance).cast("int")).alias("Number of Veterans"),
        F.when(nation != 7, nation * 100).alias("Foreign-born"),
        nation.cast("double").alias("Average Household Size"),
        segment.alias("Race"),
    )


AIRPORTS_SQL = """
    SELECT 'A' || CAST(floor(p_partkey / 4) AS BIGINT) AS ident, p_type AS type, p_name AS name,
           CASE WHEN p_size > 3 THEN 'Town ' || CAST(floor(p_partkey / 40) AS BIGINT) END
               AS municipality,
           NULLIF(p_size, 50) AS elevation_ft, p_brand AS iso_country,
           p_partkey || ', ' || p_size AS coordinates,
           CASE WHEN p_type = 'ECONOMY' THEN 'CA-S' ELSE 'US-S' END || p_size AS iso_region
    FROM part
"""


def airports(spark, folder):
    part, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        F.format_string("A%d", F.floor(part / 4)).alias("ident"),
        F.col("p_type").alias("type"),
        F.col("p_name").alias("name"),
        F.when(size > 3, F.format_string("Town %d", F.floor(part / 40))).alias("municipality"),
        F.nullif(size, F.lit(50)).alias("elevation_ft"),
        F.col("p_brand").alias("iso_country"),
        F.concat(part, F.lit(", "), size).alias("coordinates"),
        F.concat(F.when(F.col("p_type") == "ECONOMY", "CA-S").otherwise("US-S"), size)
        .alias("iso_region"),
    )


TEMPERATURES_SQL = """
    SELECT CAST(o_orderdate AS DATE) AS dt,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN 'NaN'::DOUBLE
                ELSE o_totalprice END AS "AverageTemperature",
           CASE WHEN o_orderstatus = 'F' THEN 'TOWN ' ELSE 'Town ' END || month(o_orderdate)
               AS "City",
           o_orderstatus || '1' AS "Latitude", o_orderstatus || '2' AS "Longitude"
    FROM orders
"""


def temperatures(spark, folder):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    town = F.when(status == "F", "TOWN ").otherwise("Town ")
    return table(spark, folder, "orders").select(
        F.col("o_orderdate").cast("date").alias("dt"),
        F.when(priority == "4-NOT SPECIFIED", F.lit(None).cast("double"))
        .when(priority == "5-LOW", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("AverageTemperature"),
        F.concat(town, F.month("o_orderdate")).alias("City"),
        F.concat(status, F.lit("1")).alias("Latitude"),
        F.concat(status, F.lit("2")).alias("Longitude"),
    )
