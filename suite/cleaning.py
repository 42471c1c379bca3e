"""Profiles, missing values, duplicates, fills and gates."""

from pyspark.sql import functions as F

from keelstone.operators import cleaning, fill, gates, profile
from suite.registry import query, table
from suite.standins import ARRIVALS_SQL, arrivals

# Orders with missing values of every kind: NULL text, NULL and NaN numbers,
# NULL timestamps, empty text.
GAPS_SQL = """
    SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus,
           CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                WHEN o_orderpriority = '1-URGENT' THEN 'NaN'::DOUBLE
                ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_totalprice > 100000 THEN o_orderdate END AS o_orderdate,
           CASE WHEN o_orderpriority = '2-HIGH' THEN '' ELSE o_orderpriority END AS o_orderpriority
    FROM orders
"""
_KNOWN_PRICE = "(o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))"


def gaps(spark, folder):
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    return table(spark, folder, "orders").withColumns(
        {
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
            "o_totalprice": F.when(priority == "5-LOW", F.lit(None).cast("double"))
            .when(priority == "1-URGENT", F.lit(float("nan")))
            .otherwise(price),
            "o_orderdate": F.when(price > 100000, F.col("o_orderdate")),
            "o_orderpriority": F.when(priority == "2-HIGH", "").otherwise(priority),
        }
    )


@query(
    f"""
    SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey,
           count(*) FILTER (o_custkey IS NULL) AS o_custkey,
           count(*) FILTER (o_orderstatus IS NULL) AS o_orderstatus,
           count(*) FILTER (NOT {_KNOWN_PRICE}) AS o_totalprice,
           count(*) FILTER (o_orderdate IS NULL) AS o_orderdate,
           count(*) FILTER (o_orderpriority IS NULL) AS o_orderpriority
    FROM ({GAPS_SQL})
    """
)
def null_profile(spark, folder):
    return profile.missing_profile(gaps(spark, folder))


@query(
    f"""
    SELECT count(o_orderkey) AS o_orderkey, count(o_custkey) AS o_custkey,
           count(o_orderstatus) AS o_orderstatus, count(o_totalprice) AS o_totalprice,
           count(o_orderdate) AS o_orderdate, count(o_orderpriority) AS o_orderpriority
    FROM ({GAPS_SQL})
    """
)
def non_null_profile(spark, folder):
    return profile.present_profile(gaps(spark, folder))


@query(f"SELECT count(*) FILTER (o_orderdate IS NULL) AS missing FROM ({GAPS_SQL})")
def null_single_column(spark, folder):
    return profile.missing_in(gaps(spark, folder), "o_orderdate")


@query(
    f"""
    SELECT count(*) AS rows_in,
           count(*) FILTER (o_orderstatus IS NULL OR NOT {_KNOWN_PRICE}) AS rows_dropped
    FROM ({GAPS_SQL})
    """
)
def null_drop_count(spark, folder):
    return profile.dropped_by_missing(gaps(spark, folder), ["o_orderstatus", "o_totalprice"])


@query(f"SELECT * FROM ({GAPS_SQL}) WHERE o_orderstatus IS NOT NULL AND {_KNOWN_PRICE}")
def drop_nulls_subset(spark, folder):
    return cleaning.drop_missing(gaps(spark, folder), ["o_orderstatus", "o_totalprice"])


@query(
    f"""
    SELECT * FROM ({GAPS_SQL})
    WHERE o_orderstatus IS NOT NULL AND {_KNOWN_PRICE} AND o_orderdate IS NOT NULL
    """
)
def drop_nulls_all(spark, folder):
    return cleaning.drop_missing(gaps(spark, folder))


@query(
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN {_KNOWN_PRICE} THEN o_totalprice ELSE 0 END AS o_totalprice,
           o_orderdate, o_orderpriority
    FROM ({GAPS_SQL})
    """
)
def fill_zero(spark, folder):
    return cleaning.fill_zero(gaps(spark, folder), ["o_totalprice"])


@query(f"SELECT * REPLACE (NULLIF(o_orderpriority, '') AS o_orderpriority) FROM ({GAPS_SQL})")
def empty_to_null(spark, folder):
    return cleaning.empty_to_null(gaps(spark, folder), ["o_orderpriority"])


def _filled_sql(function, frame):
    return f"""
        SELECT o_orderkey, o_custkey, o_orderstatus,
               {function}(CASE WHEN {_KNOWN_PRICE} THEN o_totalprice END IGNORE NULLS) OVER (
                   PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN {frame}
               ) AS o_totalprice, o_orderdate, o_orderpriority
        FROM ({GAPS_SQL})
    """


_FORWARD = _filled_sql("last_value", "UNBOUNDED PRECEDING AND CURRENT ROW")
_BACKWARD = _filled_sql("first_value", "CURRENT ROW AND UNBOUNDED FOLLOWING")


@query(_FORWARD)
def fill_forward(spark, folder):
    return fill.fill_forward(gaps(spark, folder), "o_totalprice", ["o_custkey"], ["o_orderkey"])


@query(_BACKWARD)
def fill_backward(spark, folder):
    return fill.fill_backward(gaps(spark, folder), "o_totalprice", ["o_custkey"], ["o_orderkey"])


# The same fills in the form used when a key is too large for one task.
@query(_FORWARD)
def fill_forward_chunked(spark, folder):
    return fill.fill_forward(
        gaps(spark, folder), "o_totalprice", ["o_custkey"], ["o_orderkey"], max_group_rows=0
    )


@query(_BACKWARD)
def fill_backward_chunked(spark, folder):
    return fill.fill_backward(
        gaps(spark, folder), "o_totalprice", ["o_custkey"], ["o_orderkey"], max_group_rows=0
    )


# A few keys hold all rows, many of them without a date, and every key is cut into chunks.
_HOT_ORDER = "o_orderdate NULLS FIRST, o_orderkey"
_HOT_FORWARD = _FORWARD.replace("PARTITION BY o_custkey ORDER BY o_orderkey", f"PARTITION BY o_orderstatus ORDER BY {_HOT_ORDER}")
_HOT_BACKWARD = _BACKWARD.replace("PARTITION BY o_custkey ORDER BY o_orderkey", f"PARTITION BY o_orderstatus ORDER BY {_HOT_ORDER}")


def _filled_hot(spark, folder, function):
    rows = gaps(spark, folder)
    return function(
        rows, "o_totalprice", ["o_orderstatus"], ["o_orderdate", "o_orderkey"],
        max_group_rows=rows.count() // 16,
    )


@query(_HOT_FORWARD)
def fill_forward_hot_key(spark, folder):
    return _filled_hot(spark, folder, fill.fill_forward)


@query(_HOT_BACKWARD)
def fill_backward_hot_key(spark, folder):
    return _filled_hot(spark, folder, fill.fill_backward)


_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_keys(spark, folder):
    return cleaning.keep_any(table(spark, folder, "lineitem"), _LINE_KEYS).select(*_LINE_KEYS)


@query(
    """
    SELECT * EXCLUDE rn FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                     l_tax, l_returnflag, l_linestatus
        ) AS rn FROM lineitem
    ) WHERE rn = 1
    """
)
def dedup_keep_first(spark, folder):
    return cleaning.keep_first(table(spark, folder, "lineitem"), _LINE_KEYS, ["l_shipdate"])


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark, folder):
    return cleaning.distinct_rows(table(spark, folder, "part"), ["p_brand", "p_type"])


@query("SELECT DISTINCT p_name FROM part")
def distinct_values(spark, folder):
    return cleaning.distinct_values(table(spark, folder, "part"), "p_name")


@query(
    """
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups FROM (
        SELECT count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus HAVING count(*) > 1
    )
    """
)
def duplicate_rows_sum(spark, folder):
    return profile.repeated_row_count(
        table(spark, folder, "orders"), ["o_custkey", "o_orderstatus"]
    )


@query(
    """
    SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS key_count,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus
    FROM lineitem
    """
)
def duplicate_surplus(spark, folder):
    return profile.surplus_rows(table(spark, folder, "lineitem"), _LINE_KEYS)


@query("SELECT * FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1")
def duplicate_listing(spark, folder):
    return cleaning.repeated_rows(table(spark, folder, "lineitem"), _LINE_KEYS)


_SHIPPED = ["l_shipdate", "l_returnflag", "l_linestatus", "l_quantity"]


@query(
    """
    SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups FROM (
        SELECT count(*) AS n FROM lineitem
        GROUP BY l_shipdate, l_returnflag, l_linestatus, l_quantity HAVING count(*) > 1
    )
    """
)
def duplicate_whole_rows(spark, folder):
    return profile.repeated_row_count(table(spark, folder, "lineitem").select(_SHIPPED))


@query(
    """
    SELECT count(*) AS row_count,
           count(DISTINCT (l_shipdate, l_returnflag, l_linestatus, l_quantity)) AS key_count,
           count(*) - count(DISTINCT (l_shipdate, l_returnflag, l_linestatus, l_quantity)) AS surplus
    FROM lineitem
    """
)
def duplicate_whole_surplus(spark, folder):
    return profile.surplus_rows(table(spark, folder, "lineitem").select(_SHIPPED))


@query(
    """
    SELECT l_shipdate, l_returnflag, l_linestatus, l_quantity FROM lineitem
    QUALIFY count(*) OVER (PARTITION BY l_shipdate, l_returnflag, l_linestatus, l_quantity) > 1
    """
)
def duplicate_whole_listing(spark, folder):
    return cleaning.repeated_rows(table(spark, folder, "lineitem").select(_SHIPPED), _SHIPPED)


@query(
    """
    SELECT count(p_partkey) - count(DISTINCT p_partkey) AS p_partkey,
           count(p_name) - count(DISTINCT p_name) AS p_name,
           count(p_brand) - count(DISTINCT p_brand) AS p_brand,
           count(p_type) - count(DISTINCT p_type) AS p_type,
           count(p_size) - count(DISTINCT p_size) AS p_size,
           count(p_retailprice) - count(DISTINCT p_retailprice) AS p_retailprice
    FROM part
    """
)
def duplicates_per_column(spark, folder):
    return profile.surplus_per_column(table(spark, folder, "part"))


def _explored(name, kind, missing):
    return f"""
        SELECT '{name}' AS column_name, '{kind}' AS column_type,
               count(*) FILTER ({missing}) AS missing, count({name}) AS present,
               count(DISTINCT {name}) AS distinct_values
        FROM ({GAPS_SQL})
    """


@query(
    " UNION ALL ".join(
        [
            _explored("o_orderkey", "bigint", "o_orderkey IS NULL"),
            _explored("o_custkey", "bigint", "o_custkey IS NULL"),
            _explored("o_orderstatus", "string", "o_orderstatus IS NULL"),
            _explored("o_totalprice", "double", f"NOT {_KNOWN_PRICE}"),
            _explored("o_orderdate", "timestamp_ntz", "o_orderdate IS NULL"),
            _explored("o_orderpriority", "string", "o_orderpriority IS NULL"),
        ]
    )
)
def exploration_report(spark, folder):
    return profile.exploration_report(gaps(spark, folder))


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """
)
def unique_key_violations(spark, folder):
    return gates.key_violations(table(spark, folder, "lineitem"), _LINE_KEYS)


@query(
    f"""
    WITH kept AS (SELECT * FROM ({ARRIVALS_SQL}) WHERE i94cit IS NOT NULL AND NOT isnan(i94cit))
    SELECT 'rows_in' AS step, count(*) AS row_count FROM lineitem
    UNION ALL
    SELECT 'missing_dropped', (SELECT count(*) FROM lineitem) - count(*) FROM kept
    UNION ALL
    SELECT 'duplicates_dropped', count(*) - count(DISTINCT cicid) FROM kept
    UNION ALL
    SELECT 'rows_out', count(DISTINCT cicid) FROM kept
    """
)
def clean_report(spark, folder):
    return cleaning.clean(arrivals(spark, folder), ["i94cit"], ["cicid"]).report
