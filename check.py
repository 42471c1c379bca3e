"""Compare every registered query with its oracle SQL in DuckDB.

    python check.py [folder] [name ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from keelstone import get_session, scratch
from suite import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type names as DuckDB writes them.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS FROM '{folder}/{name}.parquet'")
    return db


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    # repr keeps NaN comparable and tells 1 from 1.0.
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(spark, db, name: str, folder: str) -> str | None:
    """None if the query equals its oracle in names, types and rows."""
    found = QUERIES[name](spark, folder)
    expected = db.execute(ORACLES[name])
    columns = [(d[0], str(d[1])) for d in expected.description]
    types = [(n, TYPES.get(t, t)) for n, t in found.dtypes]
    if sorted(columns) != sorted(types):
        return f"columns {sorted(types)} != {sorted(columns)}"
    ours = _sorted_rows(found.columns, found.collect())
    theirs = _sorted_rows([n for n, _ in columns], expected.fetchall())
    if ours == theirs:
        return None
    extra = [r for r in ours if r not in set(theirs)][:3]
    lost = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} rows != {len(theirs)} rows; only ours {extra}; only oracle {lost}"


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = get_session("check", "local[8]", spark__ui__enabled="false",
                        spark__ui__showConsoleProgress="false",
                        spark__sql__shuffle__partitions="8")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name in names:
        started = time.perf_counter()
        try:
            problem = difference(spark, db, name, folder) if name in ORACLES else "no oracle"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.perf_counter() - started:6.2f}s {name}: {problem or 'ok'}", flush=True)
    scratch.release(spark)
    print(f"{len(names) - failed} of {len(names)} equal")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
