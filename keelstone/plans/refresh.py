"""Refresh of the arrival tables by new files, without loading the old ones again.

The cleaned arrivals are kept as a table of their own, by month of arrival, and
so is the list of the files loaded. A refresh cleans the files that are not in
that list and merges them: of rows with one cicid the same one is kept as if
all files had been loaded at once, even if another one was published before.
Only the partitions that hold new or replaced rows are written again. All
tables and the list of files are published together, so a refresh that dies is
as if it had not begun, and no file is ever loaded twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keelstone import scratch
from keelstone.functions import dates
from keelstone.functions.missing import column
from keelstone.operators import cleaning
from keelstone.plans import batch, star
from keelstone.session import shuffles_for
from keelstone.sinks.publish import PARTITIONS, TABLE, Publication, recover
from keelstone.sources.files import SourceError, exists, read_many, read_parquet, total_bytes

# The tables that only a refresh needs.
CLEANED = star.Table("Cleaned_arrivals", "Cleaned_arrivals_par", "ArriveMonth", (("cicid",),))
LOADED_FOLDER = "Loaded_files"
LOADED_SCHEMA = "path string, bytes long"


def loaded_files(spark: SparkSession, output: str) -> dict[str, int]:
    """Size of every file that the tables in `output` hold."""
    path = f"{output}/{LOADED_FOLDER}"
    if not exists(spark, path):
        return {}
    return {r.path: r.bytes for r in spark.read.schema(LOADED_SCHEMA).parquet(path).collect()}


def new_files(spark: SparkSession, output: str, paths: Sequence[str]) -> dict[str, int]:
    """The paths that are not loaded yet, with their sizes. A loaded one must not have changed."""
    before = loaded_files(spark, output)
    found = {path: total_bytes(spark, [path]) for path in paths}
    changed = [path for path, size in found.items() if before.get(path, size) != size]
    if changed:
        raise SourceError(f"these files have changed since they were loaded: {changed}")
    return {path: size for path, size in found.items() if path not in before}


def _month() -> Column:
    return F.substring(dates.day_number_to_iso(F.col("arrdate")), 1, 7).alias(CLEANED.partition_by)


class _Table:
    """A table in use, with its rows of some partition values."""

    def __init__(self, spark: SparkSession, output: str, table: star.Table, like: DataFrame):
        self.path, self.key = f"{output}/{table.folder}", table.partition_by
        self.there = exists(spark, self.path)
        self.rows = read_parquet(spark, self.path, like.schema) if self.there else like.limit(0)
        self.rows = self.rows.select([column(c) for c in like.columns])

    def folders(self, values: Sequence) -> list[str]:
        """Partition folders of these values."""
        if not self.there:
            return []
        file = F.col("_metadata.file_path")
        source = self.rows.sparkSession.read.schema(self.rows.schema).parquet(self.path)
        found = source.where(_among(self.key, values)).select(
            F.regexp_extract(file, "([^/]+)/[^/]+$", 1).alias("folder")
        )
        return [unquote(r.folder) for r in found.distinct().collect()]


def _among(name: str, values: Sequence) -> Column:
    """Never NULL; NULL is a value like others."""
    plain = [v for v in values if v is not None]
    found = F.coalesce(column(name).isin(plain), F.lit(False)) if plain else F.lit(False)
    return found | column(name).isNull() if len(plain) < len(values) else found


def _values(df: DataFrame, name: str) -> list:
    """Distinct partition values: as few as the table has folders."""
    return [r[0] for r in df.select(column(name)).distinct().collect()]


def refresh(spark: SparkSession, settings: batch.Settings) -> list[str]:
    """Load the arrival files that are new since the last refresh; their paths.

    Needs `stable_fact_id`, as running ids depend on what is loaded with a row.
    """
    if not settings.stable_fact_id:
        raise ValueError("a refresh needs stable_fact_id")
    output = settings.output
    # A refresh that died after its commit point counts as done.
    recover(spark, output, "run")
    fresh = new_files(spark, output, batch.arrival_paths(spark, settings))
    if not fresh:
        return []
    publication = Publication(spark, output)
    try:
        with shuffles_for(spark, sum(fresh.values())):
            _merge(spark, settings, publication, fresh)
    except Exception:
        publication.abandon()
        raise
    publication.commit()
    return list(fresh)


def _merge(
    spark: SparkSession, settings: batch.Settings, publication: Publication, fresh: dict[str, int]
) -> None:
    raw = read_many(
        spark, list(fresh), settings.arrivals_format, options=settings.arrivals_options,
        schema=settings.arrivals_schema,
    ).select(star.ARRIVAL_COLUMNS)
    if settings.arrivals_format.lower() not in batch.COLUMNAR_FORMATS:
        raw = scratch.stage(raw, "arrivals")

    def write(table: star.Table, rows: DataFrame, touched: Sequence, used: _Table) -> DataFrame:
        return publication.write(
            rows, table.folder, table.partition_by, gates=batch._gates(settings, table),
            replace=PARTITIONS, covers=used.folders(touched), may_be_empty=used.there,
        ).table

    def fact_and_persons() -> None:
        new = cleaning.Counted(raw, ["i94cit"], ["cicid"], "new-arrivals").frame.select("*", _month())
        old = _Table(spark, settings.output, CLEANED, new)
        on = F.col("cicid").eqNullSafe(F.col("_cicid"))
        ids = new.select(F.col("cicid").alias("_cicid"))
        both = winners = new
        stay = old.rows
        if old.there:
            # Rows in use that a new row may replace. Without any, the new rows are one per cicid already.
            rivals = scratch.stage(old.rows.join(ids, on, "left_semi"), "rivals")
            if not rivals.isEmpty():
                both = new.union(rivals)
                winners = cleaning.keep_first(both, ["cicid"])
                stay = old.rows.join(ids, on, "left_anti")
        months = _values(both, CLEANED.partition_by)
        touched = _among(CLEANED.partition_by, months)
        cleaned = write(CLEANED, stay.where(touched).union(winners), months, old)
        everything = old.rows.where(~touched).union(cleaned)

        def derived(table: star.Table, source: str, build: Callable[[DataFrame], DataFrame]) -> None:
            values = _values(both, source)
            rows = build(everything.where(_among(source, values)))
            write(table, rows, values, _Table(spark, settings.output, table, rows))

        def persons(df: DataFrame) -> DataFrame:
            return star.person_details(cleaning.drop_missing(df, ["fltno"]))

        batch._side_by_side(
            spark,
            lambda: derived(star.FACT, "visatype", lambda df: star.immigration_fact(df, stable_id=True)),
            lambda: derived(star.PERSONS, "i94mode", persons),
        )

    def arrival_dates() -> None:
        arrived = star.arrival_dates(raw, settings.distinct_dates)
        used = _Table(spark, settings.output, star.DATES, arrived)
        years = _values(arrived, star.DATES.partition_by)
        rows = used.rows.where(_among(star.DATES.partition_by, years)).union(arrived)
        write(star.DATES, rows.distinct() if settings.distinct_dates else rows, years, used)

    batch._side_by_side(spark, fact_and_persons, arrival_dates)
    known = {**loaded_files(spark, settings.output), **fresh}
    listed = spark.createDataFrame(sorted(known.items()), LOADED_SCHEMA)
    publication.write(listed.coalesce(1), LOADED_FOLDER, replace=TABLE)


def read_arrivals(spark: SparkSession, settings: batch.Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Date dimension, fact table and person dimension as they are published."""
    like = spark.createDataFrame([], read_many(
        spark, list(loaded_files(spark, settings.output))[:1], settings.arrivals_format,
        options=settings.arrivals_options, schema=settings.arrivals_schema,
    ).select(star.ARRIVAL_COLUMNS).schema)
    return tuple(
        _Table(spark, settings.output, table, frame).rows
        for table, frame in (
            (star.DATES, star.arrival_dates(like, settings.distinct_dates)),
            (star.FACT, star.immigration_fact(like, stable_id=True)),
            (star.PERSONS, star.person_details(like)),
        )
    )
