"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query after one warm-up; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from keelstone import get_session, scratch
from suite import QUERIES

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "flagship_group_count", "flagship_with_key", "flagship_sql_views", "flagship_unique_persons",
    "flagship_top50", "count_by_key_month", "null_profile", "null_drop_count", "drop_nulls_all",
    "sas_date_iso", "date_dimension", "fact_projection", "dedup_keys", "dedup_keep_first",
    "duplicate_rows_sum", "duplicate_surplus", "duplicate_listing", "duplicates_per_column",
    "exploration_report", "fill_forward", "fill_forward_chunked", "lookup_upper_fanout",
    "lookup_airports", "lookup_two_keys", "lookup_large_dictionary", "label_dictionary",
    "scan_csv_typed", "read_many_union", "partitioned_roundtrip", "star_fact",
    "star_flagship",
]


def run_once(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench", f"local[{CPUS}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run_once(spark, name)
        seconds[name] = round(statistics.median(run_once(spark, name) for _ in range(RUNS)), 3)
    scratch.release(spark)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
