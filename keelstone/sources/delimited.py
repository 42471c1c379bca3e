"""Delimited text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from keelstone.functions.missing import column
from keelstone.sources.files import SourceError, list_files


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    header: bool = True,
    types: Mapping[str, str] | None = None,
    infer: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Read delimited text.

    types:  column name -> type. Only the header lines are looked at (`header_lines`) to
            find the column order; values are then parsed straight into these types
            (text for the columns not named) in the one scan that uses them.
    infer:  let Spark derive types, which costs an extra pass over the data.
    neither: every column is text; without header named _c0, _c1, ...
    strict: a value that does not parse ends the query instead of becoming NULL.

    Files whose headers name the columns in another order are aligned by name to
    the first file; files with one header order are read as one relation.
    """
    options = {"sep": sep, "header": header, "mode": "FAILFAST" if strict else "PERMISSIVE"}

    def reader():
        return spark.read.options(**options)

    if not header:
        if types is not None:
            raise ValueError("types go by the names of a header")
        return reader().option("inferSchema", infer).csv(path)
    paths = [path] if isinstance(path, str) else list(path)
    files = [file for one in paths for file in list_files(spark, one)]
    groups: dict[tuple[str, ...], list[str]] = {}
    for line, members in header_lines(spark, files).items():
        names = tuple(reader().csv(spark.sparkContext.parallelize([line], 1)).columns)
        groups.setdefault(names, []).extend(members)
    # The first file gives the order of the columns.
    groups = dict(sorted(groups.items(), key=lambda group: min(group[1])))
    if not groups:
        raise SourceError(f"no header in {path}")
    wanted = list(next(iter(groups)))
    unknown = sorted(set(types or ()) - set(wanted))
    if unknown:
        raise ValueError(f"no such columns: {unknown}")
    frames = []
    for names, members in groups.items():
        lost = sorted(set(wanted) - set(names))
        if lost:
            raise SourceError(f"{members[0]} lacks the columns {lost}")
        if types is None:
            frame = reader().option("inferSchema", infer).csv(members)
        else:
            frame = reader().schema(_typed(names, types)).csv(members)
        frames.append(frame.select([column(n) for n in wanted]))
    return reduce(DataFrame.union, frames)


# Larger than any file: one task reads one file, and stops at its header.
_WHOLE_FILE = str(1 << 50)


def header_lines(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """Files by their header, the first line that is not blank; files without one are left out.

    One job over all files, however many: every task opens one file and stops
    at its header, so the rest of the file is not read.
    """
    if not files:
        return {}
    # A session of its own, as these settings must not meet other queries.
    session = spark.newSession()
    for name, value in {
        "spark.sql.files.maxPartitionBytes": _WHOLE_FILE, "spark.sql.files.openCostInBytes": _WHOLE_FILE,
        "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    }.items():
        session.conf.set(name, value)

    def first(batches):
        for batch in batches:
            for place, line in enumerate(batch.column("value").to_pylist()):
                if line.strip():
                    yield batch.slice(place, 1)
                    return

    lines = session.read.text(list(files)).select("value", F.col("_metadata.file_path").alias("file"))
    # Spark's metadata escape a path; the listing does not.
    found = {_plain(unquote(r.file)): r.value for r in lines.mapInArrow(first, lines.schema).collect()}
    groups: dict[str, list[str]] = {}
    for file in files:
        if _plain(file) in found:
            groups.setdefault(found[_plain(file)], []).append(file)
    return groups


def _plain(path: str) -> str:
    """A path as it can be compared: with one way to write the root of a file system."""
    scheme, colon, rest = path.partition(":/")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else scheme


def _typed(names, types: Mapping[str, str]) -> StructType:
    return StructType([
        StructField(n, _parse_datatype_string(types[n]) if n in types else StringType())
        for n in names
    ])


def unparsable(
    spark: SparkSession, path: str | list[str], types: Mapping[str, str], sep: str = ","
) -> DataFrame:
    """(column_name, bad_values): texts that are there but do not parse as their type."""
    texts = read_delimited(spark, path, sep)
    counts = texts.agg(*[
        F.count_if(column(n).isNotNull() & column(n).try_cast(t).isNull()).alias(f"_{i}")
        for i, (n, t) in enumerate(types.items())
    ])
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(f"_{i}").alias("bad_values"))
            for i, n in enumerate(types)]
    return counts.select(F.inline(F.array(*rows)))
