"""Sinks: partitioned and plain Parquet tables, and the row-count gate."""

from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.operators.gates import check_row_counts
from keelstone.sinks.parquet import write_checked, write_new
from suite.registry import query, table


@query("SELECT * FROM orders")
def partitioned_roundtrip(spark, folder):
    path = scratch.new_folder(spark, "orders-by-status")
    return write_checked(table(spark, folder, "orders"), path, "o_orderstatus").table


@query("SELECT * FROM supplier")
def unpartitioned_roundtrip(spark, folder):
    path = scratch.new_folder(spark, "supplier")
    return write_new(table(spark, folder, "supplier"), path)


@query(
    """
    SELECT l_returnflag, count(*) AS rows_before, count(*) AS rows_after
    FROM lineitem GROUP BY l_returnflag
    """
)
def row_count_gate(spark, folder):
    lines = table(spark, folder, "lineitem")
    path = scratch.new_folder(spark, "lines-by-flag")
    written, rows, _ = write_checked(lines, path, "l_returnflag")
    check_row_counts(lines.count(), rows)
    one = F.count(F.lit(1))
    before = lines.groupBy("l_returnflag").agg(one.alias("rows_before"))
    after = written.groupBy("l_returnflag").agg(one.alias("rows_after"))
    return before.join(after, "l_returnflag")
