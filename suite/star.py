"""Whole runs: raw files written from the stand-ins, star-schema tables out."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.operators import cleaning
from keelstone.plans import batch, queries, refresh, star
from suite import standins
from suite.dates import DATES_SQL, fact_sql, person_sql
from suite.lookups import airports_sql, cities_sql, temperatures_sql
from suite.registry import query


def _first_by(source, keys, order):
    ordered = ", ".join(f"{c} NULLS FIRST" for c in order)
    return f"""
        SELECT * EXCLUDE rn FROM (
            SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) AS rn
            FROM ({source})
        ) WHERE rn = 1
    """


_CLEAN_ARRIVALS = _first_by(
    f"SELECT * FROM ({standins.ARRIVALS_SQL}) WHERE i94cit IS NOT NULL AND NOT isnan(i94cit)",
    "cicid",
    ["i94cit", "i94res", "i94port", "arrdate", "depdate", "i94mode", "i94addr", "biryear",
     "gender", "fltno", "matflag", "visatype", "admnum"],
)
_TRAVELLERS = f"SELECT * FROM ({_CLEAN_ARRIVALS}) WHERE fltno IS NOT NULL"
_CLEAN_CITIES = _first_by(
    standins.CITIES_SQL,
    '"City"',
    ['"State"', '"State Code"', '"Median Age"', '"Total Population"', '"Number of Veterans"',
     '"Foreign-born"', '"Average Household Size"', '"Race"'],
)
_CLEAN_AIRPORTS = _first_by(
    standins.AIRPORTS_SQL, "ident, name",
    ["type", "municipality", "elevation_ft", "iso_country", "coordinates"],
)
_CLEAN_TEMPERATURES = _first_by(
    f"""SELECT * FROM ({standins.TEMPERATURES_SQL})
        WHERE "AverageTemperature" IS NOT NULL AND NOT isnan("AverageTemperature")""",
    '"City"',
    ["dt", '"AverageTemperature"', '"Latitude"', '"Longitude"'],
)
_FACT = fact_sql(_CLEAN_ARRIVALS)
_PERSONS = person_sql(_TRAVELLERS)
_CITIES = cities_sql(_CLEAN_CITIES)


def _settings(spark, folder, *needed):
    """Write the raw sources named in `needed` and describe the run over them."""
    base = scratch.new_folder(spark, "sources")

    def months():
        rows = standins.arrivals(spark, folder).withColumn("month", F.col("i94addr"))
        rows.write.partitionBy("month").parquet(f"{base}/arrivals")
        # As many folders as values; Spark names that of NULL itself.
        found = [r.month for r in rows.select("month").distinct().collect()]
        return [
            f"{base}/arrivals/month={'__HIVE_DEFAULT_PARTITION__' if m is None else m}"
            for m in sorted(found, key=str)
        ]

    def text(name, sep):
        frame = getattr(standins, name)(spark, folder)
        frame.write.option("header", True).option("sep", sep).csv(f"{base}/{name}")
        return f"{base}/{name}"

    writers = {
        "arrivals": months,
        "cities": lambda: text("cities", ";"),
        "airports": lambda: text("airports", ","),
        "temperatures": lambda: text("temperatures", ","),
        "labels": lambda: standins.write_label_file(spark, folder),
    }
    with ThreadPoolExecutor(len(needed)) as pool:
        written = {name: pool.submit(writers[name]) for name in needed}
        paths = {name: job.result() for name, job in written.items()}
    absent = dict.fromkeys(writers, "")
    return batch.Settings(output=f"{base}/tables", **{**absent, **paths})


def _everything(spark, folder):
    return batch.run_all(
        spark,
        _settings(spark, folder, "arrivals", "cities", "airports", "temperatures", "labels"),
    )


def _arrivals(spark, folder):
    settings = _settings(spark, folder, "arrivals")
    return batch.load_arrivals(spark, settings, batch.StageReport(spark))


def _dimension(spark, folder, name):
    settings = _settings(spark, folder, name, "labels")
    load = getattr(batch, f"load_{name}")
    report = batch.StageReport(spark)
    return load(spark, settings, batch.load_ports(spark, settings, report), report)


@query(DATES_SQL)
def star_dates(spark, folder):
    return _arrivals(spark, folder)[0]


@query(_FACT)
def star_fact(spark, folder):
    return _arrivals(spark, folder)[1].drop("Immig_Fact_ID")


@query(_PERSONS)
def star_persons(spark, folder):
    return _arrivals(spark, folder)[2]


@query(_CITIES)
def star_cities(spark, folder):
    return _dimension(spark, folder, "cities")


@query(airports_sql(_CLEAN_AIRPORTS))
def star_airports(spark, folder):
    return _dimension(spark, folder, "airports")


@query(temperatures_sql(_CLEAN_TEMPERATURES))
def star_temperatures(spark, folder):
    return _dimension(spark, folder, "temperatures")


@query(
    f"""
    SELECT "ForeignBorn", count(*) AS "count_F_Immg"
    FROM ({_FACT}) AS f JOIN ({_CITIES}) AS c ON f."AirPortCode" = c."AirPortCode"
    JOIN ({_PERSONS}) AS p ON f."cicid_Immigrant" = p."cicid_Immigrant"
    GROUP BY "ForeignBorn"
    """
)
def star_flagship(spark, folder):
    return _everything(spark, folder).arrivals_by_foreign_born(with_key=True)


@query(
    f"""
    SELECT f.*, p.* EXCLUDE ("cicid_Immigrant", "DepartureDate"),
           p."DepartureDate" AS "PersonDepartureDate", c.* EXCLUDE ("AirPortCode")
    FROM ({fact_sql(standins.ARRIVALS_SQL)}) AS f
    JOIN ({_CITIES}) AS c ON f."AirPortCode" = c."AirPortCode"
    JOIN ({_PERSONS}) AS p ON f."cicid_Immigrant" = p."cicid_Immigrant"
    """
)
def arrival_details(spark, folder):
    raw = standins.arrivals(spark, folder)
    people = cleaning.clean(raw, ["i94cit"], ["cicid"]).frame
    towns = cleaning.keep_first(standins.cities(spark, folder), ["City"])
    return queries.arrival_details(
        star.immigration_fact(raw).drop("Immig_Fact_ID"),
        star.person_details(cleaning.drop_missing(people, ["fltno"])),
        star.us_cities(towns, standins.ports(spark, folder)),
    )


def _stage_sql(stage, rows_in, rows_out):
    return f"""
        SELECT '{stage}' AS stage, (SELECT count(*) FROM ({rows_in})) AS rows_in,
               (SELECT count(*) FROM ({rows_out})) AS rows_out
    """


@query(
    " UNION ALL ".join(
        [
            "SELECT 'ports' AS stage, NULL AS rows_in, count(*) AS rows_out FROM supplier",
            _stage_sql("cleaned_arrivals", "FROM lineitem", _CLEAN_ARRIVALS),
            _stage_sql("D_DateTime", "FROM lineitem", "FROM lineitem"),
            _stage_sql("Fact_Immigrant", "FROM lineitem", _FACT),
            _stage_sql("D_Immigrant_detail", _FACT, _PERSONS),
            _stage_sql("D_USCities", "FROM customer", _CITIES),
            _stage_sql("D_AirPort", "FROM part", airports_sql(_CLEAN_AIRPORTS)),
            _stage_sql("D_WorldTemp", "FROM orders", temperatures_sql(_CLEAN_TEMPERATURES)),
            "SELECT 'run', NULL, NULL",
        ]
    )
)
def stage_report(spark, folder):
    """Rows of every stage; its times differ from run to run, but they must be in order."""
    found = _everything(spark, folder).report.to_frame()
    return found.where("seconds >= 0 and started <= ended").select("stage", "rows_in", "rows_out")


def _cleaning_sql(source, raw, kept, cleaned, table):
    misses = f"""(SELECT count(*) FROM ({table}) WHERE "AirPortCode" IS NULL)""" if table else "NULL"
    return f"""
        SELECT '{source}' AS source, r AS rows_in, r - k AS missing_dropped,
               k - c AS duplicates_dropped, c AS rows_out, {misses} AS join_misses
        FROM (SELECT (SELECT count(*) FROM ({raw})) AS r, (SELECT count(*) FROM ({kept})) AS k,
                     (SELECT count(*) FROM ({cleaned})) AS c)
    """


@query(
    " UNION ALL ".join(
        [
            _cleaning_sql(
                "arrivals", standins.ARRIVALS_SQL,
                f"SELECT * FROM ({standins.ARRIVALS_SQL}) WHERE i94cit IS NOT NULL AND NOT isnan(i94cit)",
                _CLEAN_ARRIVALS, None,
            ),
            _cleaning_sql("cities", standins.CITIES_SQL, standins.CITIES_SQL, _CLEAN_CITIES, _CITIES),
            _cleaning_sql(
                "airports", standins.AIRPORTS_SQL, standins.AIRPORTS_SQL, _CLEAN_AIRPORTS,
                airports_sql(_CLEAN_AIRPORTS),
            ),
            _cleaning_sql(
                "temperatures", standins.TEMPERATURES_SQL,
                f"""SELECT * FROM ({standins.TEMPERATURES_SQL})
                    WHERE "AverageTemperature" IS NOT NULL AND NOT isnan("AverageTemperature")""",
                _CLEAN_TEMPERATURES, temperatures_sql(_CLEAN_TEMPERATURES),
            ),
        ]
    )
)
def run_cleaning_report(spark, folder):
    return _everything(spark, folder).report.cleaning_frame()


@query(
    f"""
    SELECT count(*) AS row_count, count(*) AS ids, 0 AS null_ids, count(*) AS persons
    FROM ({_FACT})
    """
)
def star_fact_ids(spark, folder):
    """The surrogate key of the fact as written, beside its natural key."""
    return _arrivals(spark, folder)[1].agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("Immig_Fact_ID").alias("ids"),
        F.count_if(F.col("Immig_Fact_ID").isNull()).cast("int").alias("null_ids"),
        F.count_distinct("cicid_Immigrant").alias("persons"),
    )


def _refreshed(spark, folder):
    """Arrival tables loaded in two steps: some files, then the others."""
    settings = replace(_settings(spark, folder, "arrivals"), stable_fact_id=True, check_keys=True)
    paths = list(settings.arrivals)
    for count in (1 + len(paths) // 2, len(paths)):
        refresh.refresh(spark, replace(settings, arrivals=paths[:count]))
    return refresh.read_arrivals(spark, settings)


@query(_FACT)
def refresh_fact(spark, folder):
    return _refreshed(spark, folder)[1].drop("Immig_Fact_ID")


@query(_PERSONS)
def refresh_persons(spark, folder):
    return _refreshed(spark, folder)[2]


@query(DATES_SQL)
def refresh_dates(spark, folder):
    return _refreshed(spark, folder)[0]
