"""The batch run: raw sources in, checked star-schema tables out."""

from __future__ import annotations

import time
from datetime import datetime, timezone
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from keelstone import scratch
from keelstone.operators import cleaning, gates, profile
from keelstone.plans import queries, star
from keelstone.session import shuffles_for
from keelstone.sinks.parquet import write_checked
from keelstone.sinks.publish import Gate, Publication, Written
from keelstone.sources import labels
from keelstone.sources.delimited import read_delimited
from keelstone.sources.files import list_files, read_many, total_bytes, within_budget

PORTS_STAGE = "ports"
CLEANED_STAGE = "cleaned_arrivals"


@dataclass(frozen=True)
class Settings:
    """Inputs, output and switches of a run. All paths may be any Hadoop URI.

    arrivals:         a folder whose files are aligned by name, or a list of paths.
    arrivals_glob:    only files of that folder with such a name.
    arrivals_schema:  layout all arrival files are known to have; without it each
                      file's layout is looked up, which suits hundreds of files.
    infer_types:      let Spark infer the types of the delimited sources.
    city_types, airport_types, temperature_types: types instead of the fixed ones.
    strict_types:     a value that does not parse ends the run instead of becoming NULL.
    match_state:      match cities and airports to ports by city and state.
    check_keys:       prove that all keys are unique and that references are there.
    check_types:      tables must have the fixed names and types (not with infer_types).
    """

    arrivals: str | Sequence[str]
    cities: str
    airports: str
    temperatures: str
    labels: str
    output: str
    arrivals_format: str = "parquet"
    arrivals_options: Mapping[str, str] = field(default_factory=dict)
    arrivals_limit: int | None = None
    arrivals_schema: StructType | None = None
    label_section: str = labels.PORT_SECTION
    label_lines: tuple[int, int] | None = None
    distinct_dates: bool = False
    stable_fact_id: bool = False
    match_state: bool = False
    ignore_temperature_case: bool = False
    check_keys: bool = False
    check_types: bool = False
    show_missing: bool = False
    arrivals_glob: str | None = None
    infer_types: bool = False
    strict_types: bool = True
    city_types: Mapping[str, str] = field(default_factory=lambda: dict(star.CITY_TYPES))
    airport_types: Mapping[str, str] = field(default_factory=lambda: dict(star.AIRPORT_TYPES))
    temperature_types: Mapping[str, str] = field(default_factory=lambda: dict(star.TEMPERATURE_TYPES))


RowsIn = int | None | Callable[[], int]
# Formats that read single columns; others are decoded whole on every scan.
COLUMNAR_FORMATS = {"parquet", "orc"}


class StageReport:
    """Rows, seconds, start and end of each stage, and what cleaning did per source.

    Small DataFrames when asked for; all counts come from jobs that run anyway. With
    a publication the tables are written beside their places, to appear together.
    """

    _SCHEMA = (
        "stage string, rows_in long, rows_out long, seconds double, started timestamp, ended timestamp"
    )
    _CLEANING = (
        "source string, rows_in long, missing_dropped long, duplicates_dropped long, rows_out long, "
        "join_misses long"
    )
    WHOLE_RUN = "run"
    # Fixed order, as stages run side by side.
    STAGES = [
        PORTS_STAGE, CLEANED_STAGE, star.DATES.name, star.FACT.name, star.PERSONS.name,
        star.CITIES.name, star.AIRPORTS.name, star.TEMPERATURES.name, WHOLE_RUN,
    ]

    def __init__(self, spark: SparkSession, publication: Publication | None = None):
        self._spark = spark
        self._publication = publication
        self._stages: list[tuple] = []
        self._cleaning: list[tuple] = []
        self.rows: dict[str, int] = {}
        self.missing: dict[str, DataFrame] = {}

    def record(self, name: str, rows_in: int | None, rows_out: int | None, started: float) -> None:
        ended = time.time()
        times = [datetime.fromtimestamp(t, timezone.utc) for t in (started, ended)]
        self._stages.append((name, rows_in, rows_out, ended - started, *times))
        self.rows[name] = rows_out

    def cleaned(self, source: str, counts: Mapping[str, int], misses: int | None = None) -> None:
        self._cleaning.append((
            source, counts["rows_in"], counts["missing_dropped"], counts["duplicates_dropped"],
            counts["rows_out"], misses,
        ))

    def stage(self, df: DataFrame, name: str, rows_in: RowsIn) -> DataFrame:
        """Stage an intermediate frame and record it."""
        started = time.time()
        staged = scratch.stage(df, name)
        rows = staged.count()
        self.record(name, rows_in() if callable(rows_in) else rows_in, rows, started)
        return staged

    def clean(self, kept: cleaning.Counted, name: str, source: str) -> DataFrame:
        """The rows that a cleaning keeps, staged and recorded as a stage of their own."""
        started = time.time()
        counts = kept.counts()
        self.record(name, counts["rows_in"], counts["rows_out"], started)
        self.cleaned(source, counts)
        return kept.frame

    def write(
        self, df: DataFrame, table: star.Table, base: str, rows_in: RowsIn,
        metrics: Mapping[str, Column] | None = None, gates: Sequence[Gate] = (),
    ) -> Written:
        """Write one table behind its gates and record it."""
        started = time.time()
        if self._publication is None:
            written = write_checked(
                df, f"{base}/{table.folder}", table.partition_by, metrics=metrics, gates=gates
            )
        else:
            written = self._publication.write(df, table.folder, table.partition_by, metrics, gates)
        self.record(table.name, rows_in() if callable(rows_in) else rows_in, written.rows, started)
        return written

    def to_frame(self) -> DataFrame:
        stages = sorted(self._stages, key=lambda s: self.STAGES.index(s[0]))
        return self._spark.createDataFrame(stages, self._SCHEMA)

    def cleaning_frame(self) -> DataFrame:
        return self._spark.createDataFrame(sorted(self._cleaning, key=lambda c: c[0]), self._CLEANING)


def _note_missing(report: StageReport, name: str, df: DataFrame, settings: Settings) -> None:
    if settings.show_missing:
        report.missing[name] = profile.missing_profile(df)


def _side_by_side(spark: SparkSession, *jobs: Callable) -> list:
    """Submit independent jobs together, so they share the cluster."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in running]


def arrival_paths(spark: SparkSession, settings: Settings) -> list[str]:
    """Arrival files of the run: sorted, and within the file budget."""
    paths = settings.arrivals
    if isinstance(paths, str):
        paths = list_files(spark, paths, settings.arrivals_glob)
    return within_budget(paths, settings.arrivals_limit)


def load_arrivals(
    spark: SparkSession, settings: Settings, report: StageReport, paths: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Date dimension, fact table and person dimension.

    Dates cover every raw row. The cleaned rows feed two tables, so they are
    staged once: narrowed to the columns needed, free of rows without
    citizenship, one row per cicid.
    """
    raw = read_many(
        spark, paths or arrival_paths(spark, settings), settings.arrivals_format,
        options=settings.arrivals_options, schema=settings.arrivals_schema,
    )
    _note_missing(report, "arrivals", raw, settings)
    needed = raw.select(star.ARRIVAL_COLUMNS)
    if settings.arrivals_format.lower() not in COLUMNAR_FORMATS:
        needed = scratch.stage(needed, "arrivals")
    kept = cleaning.Counted(needed, ["i94cit"], ["cicid"], CLEANED_STAGE)

    def rows_in() -> int:
        return kept.counts()["rows_in"]

    def dates() -> DataFrame:
        table = star.arrival_dates(needed, settings.distinct_dates)
        return report.write(
            table, star.DATES, settings.output, rows_in, gates=_gates(settings, star.DATES)
        ).table

    def fact_and_persons() -> list[DataFrame]:
        cleaned = report.clean(kept, CLEANED_STAGE, "arrivals")

        def fact() -> DataFrame:
            table = star.immigration_fact(cleaned, settings.stable_fact_id)
            return report.write(
                table, star.FACT, settings.output, rows_in, gates=_gates(settings, star.FACT)
            ).table

        def persons() -> DataFrame:
            table = star.person_details(cleaning.drop_missing(cleaned, ["fltno"]))
            return report.write(
                table, star.PERSONS, settings.output, report.rows[CLEANED_STAGE],
                gates=_gates(settings, star.PERSONS),
            ).table

        return _side_by_side(spark, fact, persons)

    date_table, (fact_table, person_table) = _side_by_side(spark, dates, fact_and_persons)
    return date_table, fact_table, person_table


def _gates(settings: Settings, table: star.Table) -> list[Gate]:
    """What a table must pass, beyond its row count, before it is published."""
    found: list[Gate] = []
    if settings.check_types and table.types is not None:
        found.append(lambda df: gates.check_types(df, table.types))
    keys = list(table.keys) if settings.check_keys else []
    if table is star.FACT and (settings.check_keys or settings.stable_fact_id):
        keys.append(["Immig_Fact_ID"])
    found += [lambda df, key=key: gates.check_unique(df, key) for key in keys]
    return found


def check_references(
    settings: Settings, dates: DataFrame, fact: DataFrame, persons: DataFrame,
    lookups: Mapping[str, DataFrame], ports: DataFrame,
) -> None:
    """Every key that a table of the run refers to must be there.

    Ports of arrivals may be unknown to the dictionary and persons without a
    flight number are left out, so those two are no references.
    """
    if not settings.check_keys:
        return
    gates.check_references(fact, ["ArriveDate"], dates, ["ArriveDate"])
    gates.check_references(fact, ["DepartureDate"], dates, ["DepartureDate"])
    gates.check_references(persons, ["cicid_Immigrant"], fact, ["cicid_Immigrant"])
    for table in lookups.values():
        gates.check_references(table, ["AirPortCode"], ports, ["PortCode"])


def _read(
    spark: SparkSession, settings: Settings, path: str, types: Mapping[str, str], sep: str = ","
) -> DataFrame:
    if settings.infer_types:
        return read_delimited(spark, path, sep, infer=True)
    return read_delimited(spark, path, sep, types=types, strict=settings.strict_types)


def _write_lookup(
    report: StageReport, settings: Settings, source: str, table: star.Table, df: DataFrame,
    kept: cleaning.Counted,
) -> DataFrame:
    """Write a dimension and record its cleaning and the rows that found no port."""
    counts = kept.counts()
    written = report.write(
        df, table, settings.output, counts["rows_in"],
        {"misses": F.count_if(F.col("AirPortCode").isNull())}, _gates(settings, table),
    )
    report.cleaned(source, counts, written.metrics["misses"])
    return written.table


def load_cities(
    spark: SparkSession, settings: Settings, ports: DataFrame, report: StageReport
) -> DataFrame:
    raw = _read(spark, settings, settings.cities, settings.city_types, ";")
    _note_missing(report, "cities", raw, settings)
    needed = raw.select([f"`{c}`" for c in star.CITY_COLUMNS])
    kept = cleaning.Counted(needed, dup_keys=["City"], label="cities")
    table = star.us_cities(kept.frame, ports, settings.match_state)
    return _write_lookup(report, settings, "cities", star.CITIES, table, kept)


def load_airports(
    spark: SparkSession, settings: Settings, ports: DataFrame, report: StageReport
) -> DataFrame:
    raw = _read(spark, settings, settings.airports, settings.airport_types)
    _note_missing(report, "airports", raw, settings)
    region = [star.REGION_COLUMN] if settings.match_state else []
    needed = raw.select(star.AIRPORT_COLUMNS + region)
    kept = cleaning.Counted(needed, dup_keys=["ident", "name"], label="airports")
    table = star.airports(kept.frame, ports, settings.match_state)
    return _write_lookup(report, settings, "airports", star.AIRPORTS, table, kept)


def load_temperatures(
    spark: SparkSession, settings: Settings, ports: DataFrame, report: StageReport
) -> DataFrame:
    raw = _read(spark, settings, settings.temperatures, settings.temperature_types)
    _note_missing(report, "temperatures", raw, settings)
    kept = cleaning.Counted(
        raw.select(star.TEMPERATURE_COLUMNS), ["AverageTemperature"], ["City"], "temperatures"
    )
    table = star.world_temperatures(kept.frame, ports, settings.ignore_temperature_case)
    return _write_lookup(report, settings, "temperatures", star.TEMPERATURES, table, kept)


def load_ports(spark: SparkSession, settings: Settings, report: StageReport) -> DataFrame:
    """Port dictionary, parsed once for all the lookups that use it."""
    ports = labels.read_ports(
        spark, settings.labels, settings.label_section, settings.label_lines
    )
    return report.stage(ports, PORTS_STAGE, None)


@dataclass(frozen=True)
class Run:
    dates: DataFrame
    fact: DataFrame
    persons: DataFrame
    cities: DataFrame
    airports: DataFrame
    temperatures: DataFrame
    report: StageReport
    partitions: int

    def arrivals_by_foreign_born(self, with_key: bool = False) -> DataFrame:
        """The closing question of a run. cicid is unique after cleaning.

        Its tables are dealt by their join key into the number of partitions that suits
        the run's inputs, so the question does not depend on the session's setting.
        """
        def dealt(df: DataFrame, key: str) -> DataFrame:
            session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            return df if self.partitions <= session else df.repartition(self.partitions, key)

        return queries.arrivals_by_foreign_born(
            dealt(self.fact, "cicid_Immigrant"), dealt(self.persons, "cicid_Immigrant"),
            self.cities, with_key, unique_persons=True,
        )


def run_all(spark: SparkSession, settings: Settings) -> Run:
    """Build, write and check all six tables and register the query views.

    The four sources do not depend on each other, so their jobs are submitted
    side by side and share the cluster. The tables appear together, after the
    gates of all: a run that fails leaves those of the last one in place.
    """
    publication = Publication(spark, settings.output)
    report = StageReport(spark, publication)

    def lookups() -> list[DataFrame]:
        ports = load_ports(spark, settings, report)
        loads = (load_cities, load_airports, load_temperatures)
        return [ports, *_side_by_side(
            spark, *[lambda load=load: load(spark, settings, ports, report) for load in loads]
        )]

    started = time.time()
    paths = arrival_paths(spark, settings)
    inputs = [*paths, settings.cities, settings.airports, settings.temperatures]
    try:
        with shuffles_for(spark, total_bytes(spark, inputs)) as partitions:
            (dates, fact, persons), (ports, *places) = _side_by_side(
                spark, lambda: load_arrivals(spark, settings, report, paths), lookups
            )
            check_references(
                settings, dates, fact, persons, dict(zip(("cities", "airports", "temperatures"), places)), ports
            )
    except Exception:
        publication.abandon()
        raise
    tables = publication.commit()
    report.record(StageReport.WHOLE_RUN, None, None, started)
    dates, fact, persons, cities, airports, temperatures = (
        tables[t.folder]
        for t in (star.DATES, star.FACT, star.PERSONS, star.CITIES, star.AIRPORTS, star.TEMPERATURES)
    )
    queries.register_views(fact, persons, cities)
    return Run(dates, fact, persons, cities, airports, temperatures, report, partitions)
