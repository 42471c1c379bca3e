"""Join-aggregate questions: orders as facts, lineitem as persons, customer as cities."""

from pyspark.sql import functions as F

from keelstone.operators import skew
from keelstone.plans import queries
from suite.registry import query, table

_COUNTS = """
    SELECT c_nationkey AS "ForeignBorn", count(*) AS "count_F_Immg"
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN lineitem ON o_orderkey = l_orderkey
    GROUP BY c_nationkey
"""


def _stand_ins(spark, folder):
    fact = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("cicid_Immigrant"), F.col("o_custkey").alias("AirPortCode")
    )
    persons = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("cicid_Immigrant")
    )
    cities = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("AirPortCode"), F.col("c_nationkey").alias("ForeignBorn")
    )
    return fact, persons, cities


@query(f'SELECT "count_F_Immg" FROM ({_COUNTS}) ORDER BY 1 DESC')
def flagship_group_count(spark, folder):
    return queries.arrivals_by_foreign_born(*_stand_ins(spark, folder))


@query(_COUNTS)
def flagship_with_key(spark, folder):
    return queries.arrivals_by_foreign_born(*_stand_ins(spark, folder), with_key=True)


@query(_COUNTS)
def flagship_sql_views(spark, folder):
    queries.register_views(*_stand_ins(spark, folder))
    return queries.arrivals_by_foreign_born_sql(spark, with_key=True)


@query(
    """
    SELECT "ForeignBorn", count(*) AS "count_F_Immg"
    FROM (SELECT DISTINCT l_orderkey FROM lineitem)
    JOIN orders ON l_orderkey = o_orderkey
    JOIN (SELECT c_custkey, c_nationkey AS "ForeignBorn" FROM customer) ON o_custkey = c_custkey
    GROUP BY "ForeignBorn"
    """
)
def flagship_unique_persons(spark, folder):
    fact, persons, cities = _stand_ins(spark, folder)
    return queries.arrivals_by_foreign_born(
        fact, persons.distinct(), cities, with_key=True, unique_persons=True
    )


@query(
    """
    SELECT o_custkey, count(*) AS row_count FROM orders
    GROUP BY o_custkey ORDER BY row_count DESC, o_custkey LIMIT 50
    """
)
def flagship_top50(spark, folder):
    return queries.largest_groups(table(spark, folder, "orders"), "o_custkey", 50)


@query(
    """
    SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS row_count
    FROM orders GROUP BY ALL
    """
)
def count_by_key_month(spark, folder):
    return queries.count_by_period(table(spark, folder, "orders"), "o_orderstatus", "o_orderdate")


@query(
    """
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS row_count
    FROM orders GROUP BY ALL
    """
)
def count_by_key_year(spark, folder):
    orders = table(spark, folder, "orders")
    return queries.count_by_period(orders, "o_custkey", "o_orderdate", monthly=False)


@query(
    """
    WITH o AS (SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
                      CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
    SELECT 0 AS level, o_orderstatus, NULL AS o_orderpriority, year, month, count(*) AS row_count
    FROM o GROUP BY o_orderstatus, year, month
    UNION ALL
    SELECT 1, NULL, o_orderpriority, year, NULL, count(*) FROM o GROUP BY o_orderpriority, year
    UNION ALL
    SELECT 2, NULL, NULL, NULL, NULL, count(*) FROM o
    """
)
def count_levels(spark, folder):
    """Orders by status and month, by priority and year, and in total, from one pass."""
    orders = table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )
    levels = [["o_orderstatus", "year", "month"], ["o_orderpriority", "year"], []]
    return queries.count_levels(orders, levels, ["o_orderstatus", "o_orderpriority", "year", "month"])


@query(
    """
    WITH o AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS k, o_orderkey FROM orders),
    c AS (SELECT CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey END AS k, c_nationkey FROM customer)
    SELECT k, count(*) AS pairs, CAST(sum(o_orderkey) AS BIGINT) AS orders,
           CAST(sum(c_nationkey) AS BIGINT) AS nations
    FROM o JOIN c USING (k) GROUP BY k
    """
)
def join_hot_key(spark, folder):
    """Pairs of two tables that have a third of their rows on one key."""
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    left = orders.select(F.expr("IF(o_orderkey % 3 = 0, 0, o_custkey)").alias("k"), "o_orderkey")
    right = customers.select(F.expr("IF(c_custkey % 3 = 0, 0, c_custkey)").alias("k"), "c_nationkey")
    return skew.pair_sums(left, right, ["k"], "pairs", {"orders": "o_orderkey"}, {"nations": "c_nationkey"})


@query("SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def preview_rows(spark, folder):
    return queries.preview(table(spark, folder, "orders"), 5, "o_orderdate", "o_orderkey")
