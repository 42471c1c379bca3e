"""Spark session set-up."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the plans in this package count on. All are ordinary Spark options;
# anything passed to `get_session` or set on the cluster afterwards wins.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Also the size at which a rebalance cuts hot partition values: larger
    # output files than the 64 MB Spark starts from.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_session(app_name: str = "keelstone", master: str | None = None, **conf) -> SparkSession:
    """Return a session with the package defaults.

    `conf` takes option names with dots written as double underscores, e.g.
    ``spark__sql__shuffle__partitions=64``. Without `master` the launcher's
    choice (spark-submit, cluster manager) stands.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITION_BYTES = 200 * 1024 * 1024


@contextmanager
def shuffles_for(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Raise the number of shuffle partitions to suit an input of this size.

    Adaptive execution merges small partitions but only splits large ones in
    skewed joins and rebalances, so the number to start from has to grow with
    the data. A higher setting stands; the old one returns at the end.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = -(-input_bytes // PARTITION_BYTES)
    number = max(int(before), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", number)
    try:
        yield number
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
