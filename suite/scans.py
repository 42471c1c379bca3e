"""Sources: delimited text, multi-file reads and label dictionaries.

Each query first writes a given table in the format to be read, into the
shared scratch folder, and then reads it back.
"""

from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.sources import labels
from keelstone.sources.delimited import read_delimited, unparsable
from keelstone.sources.files import list_files, read_many
from suite.registry import query, table
from suite.standins import PORT_LINES_SQL, port_lines, write_label_file

_PORTS_SQL = """
    SELECT code AS "PortCode",
           CASE WHEN label LIKE '%,%' THEN trim(split_part(label, ',', 1))
                ELSE 'UnknownCity' END AS "CityName",
           CASE WHEN label LIKE '%,%' THEN trim(split_part(label, ',', 2))
                ELSE 'UnknownState' END AS "StateCode"
    FROM (
        SELECT trim(replace(trim(split_part(line, '=', 1), chr(9) || ' '), '''', '')) AS code,
               trim(replace(trim(split_part(line, '=', 2), chr(9) || ' '), '''', '')) AS label
        FROM ({lines})
    )
"""


def _as_csv(spark, folder, name, sep, header):
    path = scratch.new_folder(spark, f"{name}-csv")
    table(spark, folder, name).write.option("sep", sep).option("header", header).csv(path)
    return path


@query(
    """
    SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer
    """
)
def scan_csv_semicolon(spark, folder):
    path = _as_csv(spark, folder, "customer", ";", True)
    return read_delimited(spark, path, sep=";", infer=True)


@query(
    """
    SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    FROM part
    """
)
def scan_csv_default(spark, folder):
    return read_delimited(spark, _as_csv(spark, folder, "part", ",", True), infer=True)


@query("SELECT * FROM orders")
def scan_csv_typed(spark, folder):
    types = {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
    }
    return read_delimited(spark, _as_csv(spark, folder, "orders", ";", True), ";", types=types)


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS _c0, s_name AS _c1, CAST(s_nationkey AS VARCHAR) AS _c2,
           CAST(s_acctbal AS VARCHAR) AS _c3
    FROM supplier
    """
)
def scan_csv_untyped(spark, folder):
    path = _as_csv(spark, folder, "supplier", ";", False)
    return read_delimited(spark, path, sep=";", header=False)


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_csv_permuted(spark, folder):
    """Files of one folder whose headers have two column orders."""
    base = scratch.new_folder(spark, "permuted-csv")
    rows = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    orders = rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 <> 0").select(
        "o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"
    )
    for part in orders:
        part.write.mode("append").option("sep", ";").option("header", True).csv(base)
    types = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return read_delimited(spark, base, ";", types=types).select(rows.columns)


@query(
    """
    SELECT 'p_size' AS column_name, count(*) FILTER (p_size % 5 = 0) AS bad_values FROM part
    UNION ALL SELECT 'p_partkey', 0
    """
)
def scan_csv_bad_values(spark, folder):
    """Every fifth size is written as a fraction, every seventh is missing."""
    path = scratch.new_folder(spark, "bad-csv")
    size = F.when(F.col("p_size") % 5 == 0, F.concat("p_size", F.lit(".5"))).when(
        F.col("p_size") % 7 != 0, F.col("p_size").cast("string")
    )
    parts = table(spark, folder, "part").select("p_partkey", size.alias("p_size"))
    parts.write.option("header", True).csv(path)
    return unparsable(spark, path, {"p_size": "int", "p_partkey": "bigint"})


def _order_files(spark, folder):
    """Orders by status in three folders; later ones have other column layouts."""
    orders = table(spark, folder, "orders")
    base = scratch.new_folder(spark, "order-files")
    permuted = orders.select(orders.columns[::-1])
    layouts = {"F": orders, "O": permuted, "P": permuted.withColumn("extra", F.lit(1))}
    for status, rows in layouts.items():
        rows.where(F.col("o_orderstatus") == status).write.parquet(f"{base}/{status}")
    return [f"{base}/{status}" for status in layouts]


@query("SELECT * FROM orders")
def read_many_union(spark, folder):
    folders = _order_files(spark, folder)
    files = [path for one in folders for path in list_files(spark, one, "*.parquet")]
    return read_many(spark, files)


@query("SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')")
def read_many_limit(spark, folder):
    return read_many(spark, _order_files(spark, folder), limit=2)


@query(_PORTS_SQL.format(lines=PORT_LINES_SQL))
def label_dictionary(spark, folder):
    return labels.read_ports(spark, write_label_file(spark, folder))


@query("SELECT CAST(p_partkey AS VARCHAR) AS code, p_name AS label FROM part")
def label_sections(spark, folder):
    return labels.read_section(
        spark, write_label_file(spark, folder), labels.COUNTRY_SECTION
    )


@query(_PORTS_SQL.format(lines=PORT_LINES_SQL))
def label_lines(spark, folder):
    return labels.to_ports(labels.entries(port_lines(spark, folder)))


@query(_PORTS_SQL.format(lines=f"""
    SELECT line FROM ({PORT_LINES_SQL.replace("AS line", "AS line, s_suppkey")})
    WHERE s_suppkey >= 3 AND s_suppkey < 8
"""))
def label_line_range(spark, folder):
    """Entries on the lines [2, 7) of a file of port lines alone, in key order."""
    path = scratch.new_folder(spark, "port-lines")
    key = F.regexp_extract("line", "'P([0-9]+)'", 1).cast("long")
    lines = port_lines(spark, folder).withColumn("key", key).repartitionByRange(1, "key")
    lines.sortWithinPartitions("key").select("line").write.text(path)
    first = lines.agg(F.min("key")).first()[0]
    return labels.to_ports(labels.read_line_range(spark, path, (3 - first, 8 - first)))
