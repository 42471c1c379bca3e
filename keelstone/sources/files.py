"""File listing and multi-file reads."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from keelstone.functions.missing import column

LOOKUP_THREADS = 16

# Formats of Spark's own that read many paths of one layout as one relation.
SPLITTABLE_FORMATS = {"parquet", "orc", "csv", "json", "avro"}


class SourceError(ValueError):
    """The given sources cannot be read as one table."""


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> list[str]:
    """Sorted paths of the regular files directly inside `folder`.

    One listing by the Hadoop file system of the path; no job runs and no file is
    opened. Hidden files (names with a leading _ or .) are left out, as Spark does.
    """
    path, system = _file_system(spark, folder)
    found = system.globStatus(path) or []
    if len(found) == 1 and found[0].isDirectory():
        found = system.listStatus(found[0].getPath())
    files = [
        (s.getPath().getName(), s.getPath().toString()) for s in found if not s.isDirectory()
    ]
    if not files and not found:
        raise SourceError(f"no such folder: {folder}")
    return sorted(
        full for name, full in files
        if name[0] not in "_." and (glob is None or fnmatchcase(name, glob))
    )


def total_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of all files at or below `paths`, from the listing alone."""
    total = 0
    for one in paths:
        path, system = _file_system(spark, one)
        for status in system.globStatus(path) or []:
            total += system.getContentSummary(status.getPath()).getLength()
    return total


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _file_system(spark, path)
    return system.exists(where)


def _file_system(spark: SparkSession, folder: str):
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(context._jsc.hadoopConfiguration())


def within_budget(paths: Sequence[str], limit: int | None) -> list[str]:
    """First `limit` paths in name order; no limit (None or <= 0) keeps all."""
    if not paths:
        raise SourceError("no input files")
    ordered = sorted(paths)
    return ordered if limit is None or limit <= 0 else ordered[:limit]


def read_many(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    limit: int | None = None,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Bag union of several files, aligned by name to the first one.

    Columns come in the first file's order; a later file may order them
    differently or hold more (ignored), but a missing one is an error. Files
    are grouped by layout and every layout is read as one relation, so the
    plan has as many inputs as there are layouts, not files. With `schema`
    all files are trusted to have it and no layout is looked up. `fmt` may
    also name a third-party source; its files are read one by one.
    """
    chosen = within_budget(paths, limit)
    options = dict(options or {})

    def reader():
        return spark.read.format(fmt).options(**options)

    if schema is not None:
        return reader().schema(schema).load(chosen)

    with ThreadPoolExecutor(LOOKUP_THREADS) as pool:
        layouts = list(pool.map(lambda p: reader().load(p).schema, chosen))
    wanted = layouts[0].fieldNames()
    grouped = fmt.lower() in SPLITTABLE_FORMATS
    groups: dict[str, tuple[StructType, list[str]]] = {}
    exact = spark.conf.get("spark.sql.caseSensitive") == "true"
    for path, layout in zip(chosen, layouts):
        there = {n if exact else n.lower() for n in layout.fieldNames()}
        lost = [name for name in wanted if (name if exact else name.lower()) not in there]
        if lost:
            raise SourceError(f"{path} lacks the columns {lost}")
        groups.setdefault(layout.json() if grouped else path, (layout, []))[1].append(path)
    frames = [
        (reader().schema(layout).load(members) if grouped else reader().load(members[0]))
        for layout, members in groups.values()
    ]
    return reduce(
        DataFrame.union, (f.select([column(n).alias(n) for n in wanted]) for f in frames)
    )


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan. With `schema`, partition values keep the given types."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
