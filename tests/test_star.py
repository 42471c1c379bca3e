import math
import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from keelstone import DataQualityError, Settings, run_all
from keelstone.__main__ import main
from keelstone.operators import cleaning
from keelstone.plans import batch, queries, star
from keelstone.plans.batch import arrival_paths
from keelstone.session import shuffles_for
from keelstone.sources.files import list_files
from suite import QUERIES
from tests.conftest import final_plan, rows

ARRIVALS = [
    # cicid, i94cit, i94res, i94port, arrdate, depdate, mode, addr, born, gender, fltno, match, visa
    (1.0, 101.0, 101.0, "AAA", 20574.0, 20580.0, 1.0, "AL", 1980.0, "F", "10", "M", "B2"),
    (1.0, 102.0, 101.0, "AAA", 20574.0, None, 1.0, "AL", 1980.0, "F", "11", "M", "B2"),
    (2.0, 101.0, 101.0, "AAA", 20575.0, 0.0, 2.0, None, 1990.0, None, "12", None, "B1"),
    (3.0, None, 101.0, "BBB", 20576.0, None, 1.0, "CA", 1990.0, "M", "13", None, "B2"),
    (4.0, math.nan, 101.0, "BBB", 20576.0, None, 1.0, "CA", 1990.0, "M", "13", None, "B2"),
    (5.0, 103.0, 101.0, "BBB", 20577.5, None, None, "CA", 1990.0, "M", None, None, "B2"),
    (6.0, 103.0, 101.0, "ZZZ", 20577.0, None, 3.0, "CA", 1990.0, "M", "14", None, "WT"),
]
_TYPES = (
    "cicid double, i94cit double, i94res double, i94port string, arrdate double, depdate double, "
    "i94mode double, i94addr string, biryear double, gender string, fltno string, matflag string, "
    "visatype string"
)
LABELS = """value $i94prtl
'AAA' = 'SPRINGFIELD, IL'
'AA2' = 'SPRINGFIELD, MO'
'BBB' = 'SHELBYVILLE, TN'
;
"""
CITIES = """City;State;Median Age;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race
Springfield;Illinois;33.5;1000;10;77;2.5;IL;X
Springfield;Missouri;34.5;2000;20;78;2.5;MO;Y
Shelbyville;Tennessee;30;500;;;2.1;TN;X
"""
AIRPORTS = """ident,type,name,elevation_ft,iso_country,iso_region,municipality,coordinates
I1,small_airport,One,11,US,US-MO,springfield,"-70, 40"
I1,small_airport,One,12,US,US-MO,springfield,"-70, 40"
I2,heliport,Two,,CA,CA-ON,Ottawa,"-75, 45"
"""
TEMPERATURES = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
1850-01-01,,1.0,Springfield,US,40N,70W
1850-02-01,5.5,1.0,Springfield,US,40N,70W
1850-03-01,9.5,1.0,Springfield,US,40N,70W
1850-01-01,2.5,1.0,SHELBYVILLE,US,35N,80W
"""


@pytest.fixture
def sources(spark, tmp_path):
    frame = spark.createDataFrame(ARRIVALS, _TYPES).withColumn("admnum", F.col("cicid") * 100)
    for month, low, high in (("apr", 0, 3), ("may", 4, 9)):
        part = frame.where(F.col("cicid").between(low, high))
        columns = frame.columns if month == "apr" else frame.columns[::-1]
        part.select(columns).coalesce(1).write.parquet(str(tmp_path / month))
    texts = {"labels": LABELS, "cities": CITIES, "airports": AIRPORTS, "temperatures": TEMPERATURES}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    return Settings(
        arrivals=[str(tmp_path / "apr"), str(tmp_path / "may")],
        output=str(tmp_path / "out"),
        **{name: str(tmp_path / f"{name}.txt") for name in texts},
    )


def test_whole_run(spark, sources):
    run = run_all(spark, sources)
    assert rows(run.fact.drop("Immig_Fact_ID")) == [
        (1.0, "AAA", "2016-04-30", "2016-05-06", 101.0, "B2", 100.0),
        (2.0, "AAA", "2016-05-01", None, 101.0, "B1", 200.0),
        (5.0, "BBB", "2016-05-03", None, 101.0, "B2", 500.0),
        (6.0, "ZZZ", "2016-05-03", None, 101.0, "WT", 600.0),
    ]
    assert run.fact.select("Immig_Fact_ID").distinct().count() == 4
    assert rows(run.persons) == [
        (1.0, 101.0, "AL", 20580.0, 1.0, 1980.0, "F", "10", "M"),
        (2.0, 101.0, None, 0.0, 2.0, 1990.0, None, "12", None),
        (6.0, 103.0, "CA", None, 3.0, 1990.0, "M", "14", None),
    ]
    assert run.dates.count() == len(ARRIVALS)
    assert rows(run.dates.where("ArriveDate = '2016-04-30'").distinct()) == [
        ("2016-04-30", 2016, 4, 30, "Saturday", "2016-05-06"),
        ("2016-04-30", 2016, 4, 30, "Saturday", None),
    ]
    # One row per city name is left, then it fans out to both ports of that name.
    assert rows(run.cities.select("AirPortCode", "CityName", "StateCode", "ForeignBorn")) == [
        ("AA2", "SPRINGFIELD", "IL", 77),
        ("AAA", "SPRINGFIELD", "IL", 77),
        ("BBB", "SHELBYVILLE", "TN", None),
    ]
    assert rows(run.airports.drop("Coordinates")) == [
        ("AA2", "I1", "small_airport", "One", "SPRINGFIELD", 11, "US"),
        ("AAA", "I1", "small_airport", "One", "SPRINGFIELD", 11, "US"),
        (None, "I2", "heliport", "Two", "OTTAWA", None, "CA"),
    ]
    assert rows(run.temperatures.select("AirPortCode", "AvgTemperature", "CityName")) == [
        ("BBB", 2.5, "SHELBYVILLE"), (None, 5.5, "Springfield"),
    ]
    # cicid 1 and 2 arrive at AAA; 5 has no person, 6 no city.
    assert rows(run.arrivals_by_foreign_born(with_key=True)) == [(77, 2)]
    assert queries.arrivals_by_foreign_born_sql(spark).collect() == [(2,)]
    times = run.report.to_frame()
    assert times.where("started > ended or seconds < 0").count() == 0
    assert rows(run.report.cleaning_frame()) == rows([
        ("arrivals", 7, 2, 1, 4, None), ("cities", 3, 0, 1, 2, 0), ("airports", 3, 0, 1, 2, 1),
        ("temperatures", 4, 1, 1, 2, 1),
    ])
    assert [tuple(r)[:3] for r in times.collect()] == [
        ("ports", None, 3), ("cleaned_arrivals", 7, 4), ("D_DateTime", 7, 7),
        ("Fact_Immigrant", 7, 4), ("D_Immigrant_detail", 4, 3),
        ("D_USCities", 3, 3), ("D_AirPort", 3, 3), ("D_WorldTemp", 4, 2), ("run", None, None),
    ]


def test_options(spark, sources):
    chosen = replace(
        sources, arrivals_limit=1, match_state=True, ignore_temperature_case=True,
        distinct_dates=True, stable_fact_id=True, show_missing=True, check_keys=True, check_types=True,
    )
    run = run_all(spark, chosen)
    assert run.fact.count() == 2
    assert run.dates.count() == 4
    assert rows(run.cities.select("AirPortCode", "StateCode")) == [("AAA", "IL"), ("BBB", "TN")]
    assert rows(run.temperatures.select("AirPortCode", "CityName")) == [
        ("AA2", "Springfield"), ("AAA", "Springfield"), ("BBB", "SHELBYVILLE"),
    ]
    assert rows(run.airports.select("AirPortCode", "AirPortID")) == [("AA2", "I1"), (None, "I2")]
    missing = run.report.missing
    assert missing["arrivals"].first()["i94cit"] == 1
    assert missing["cities"].first()["Foreign-born"] == 1
    again = star.immigration_fact(run.fact.selectExpr(
        "cicid_Immigrant AS cicid", "AirPortCode AS i94port", "1D AS arrdate", "1D AS depdate",
        "FromResidence AS i94res", "VisaType AS visatype", "AdminNumber AS admnum",
    ), stable_id=True)
    assert rows(again.select("Immig_Fact_ID")) == rows(run.fact.select("Immig_Fact_ID"))


def test_a_run_without_usable_rows_stops(spark, sources):
    incomplete = replace(sources, arrivals=_only_incomplete(spark, sources))
    with pytest.raises(DataQualityError):
        batch.load_arrivals(spark, incomplete, batch.StageReport(spark))


def _only_incomplete(spark, sources):
    path = sources.output + "-incomplete"
    spark.read.parquet(sources.arrivals[0]).withColumn(
        "i94cit", F.lit(None).cast("double")
    ).write.parquet(path)
    return [path]


def _brute_force(fact, persons, cities):
    counts = {}
    for cicid, port in fact:
        for city_port, born in cities:
            if port is not None and city_port == port:
                n = sum(1 for p in persons if p == cicid)
                if n:
                    counts[born] = counts.get(born, 0) + n
    return sorted(counts.items(), key=repr)


def test_flagship_with_hot_keys_equals_brute_force(spark):
    fact = [(i % 40 if i % 3 else 0, None if i % 11 == 0 else f"P{i % 7 if i % 2 else 0}")
            for i in range(300)]
    persons = [i % 50 if i % 3 else 0 for i in range(200)]
    cities = [(f"P{i % 5}", None if i % 4 == 0 else i % 3) for i in range(12)] + [(None, 9)]
    frames = (
        spark.createDataFrame(fact, "cicid_Immigrant int, AirPortCode string"),
        spark.createDataFrame([(p,) for p in persons], "cicid_Immigrant int"),
        spark.createDataFrame(cities, "AirPortCode string, ForeignBorn int"),
    )
    expected = _brute_force(fact, persons, cities)
    assert rows(queries.arrivals_by_foreign_born(*frames, with_key=True)) == expected
    queries.register_views(*frames)
    assert rows(queries.arrivals_by_foreign_born_sql(spark, with_key=True)) == expected
    once = (frames[0], frames[1].distinct(), frames[2])
    expected = _brute_force(fact, set(persons), cities)
    unique = queries.arrivals_by_foreign_born(*once, with_key=True, unique_persons=True)
    assert rows(unique) == expected


def test_flagship_never_forms_the_pairs_of_a_hot_key(spark):
    size = 300_000
    fact = spark.range(size).selectExpr(
        "IF(id % 3 = 0, 0, id) AS cicid_Immigrant", "IF(id % 3 = 0, 'P', 'Q') AS AirPortCode"
    )
    persons = spark.range(size).selectExpr("IF(id % 3 = 0, 0, id) AS cicid_Immigrant")
    cities = spark.createDataFrame([("P", 1), ("Q", 2)], "AirPortCode string, ForeignBorn int")
    counts = queries.arrivals_by_foreign_born(fact, persons, cities, with_key=True)
    assert rows(counts) == [(1, (size // 3) ** 2), (2, size - size // 3)]


def test_flagship_reads_only_keys(spark):
    plan = final_plan(QUERIES["flagship_group_count"](spark, "/root/testdata/sf0.001"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
    assert "PushedFilters: [IsNotNull(o_custkey)" in plan


def test_missing_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = final_plan(cleaning.drop_missing(orders, ["o_custkey"]).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_custkey)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_top_groups_and_months(spark):
    df = spark.sql(
        """
        SELECT * FROM VALUES ('a', date'2020-01-05'), ('a', date'2020-01-09'),
        ('b', date'2020-02-01'), ('c', date'2019-02-01'), (NULL, NULL) AS t(k, d)
        """
    )
    assert [tuple(r) for r in queries.largest_groups(df, "k", 3).collect()] == [
        ("a", 2), (None, 1), ("b", 1),
    ]
    assert ("a", 2020, 2) in rows(queries.count_by_period(df, "k", "d", monthly=False))
    assert rows(queries.count_by_period(df, "k", "d")) == [
        ("a", 2020, 1, 2), ("b", 2020, 2, 1), ("c", 2019, 2, 1), (None, None, None, 1),
    ]
    assert queries.preview(df, 2).count() == 2
    assert queries.preview(df.dropna(), 1, "d").first().k == "c"


def test_shuffles_grow_with_the_input(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    for size, number in ((10, int(before)), (1024**4, 5243), (100 * 1024**4, 524_288)):
        with shuffles_for(spark, size) as chosen:
            assert chosen == number == int(spark.conf.get(setting))
        assert spark.conf.get(setting) == before


def test_command_line(spark, sources, capsys):
    names = ("cities", "airports", "temperatures", "labels", "output")
    paths = [p for n in names for p in (f"--{n}", getattr(sources, n))]
    arrivals = sources.arrivals[0]
    main(["--arrivals", arrivals, "--arrivals-limit", "1", "--show-missing", *paths])
    shown = capsys.readouterr().out
    assert "Missing values in arrivals" in shown and "Fact_Immigrant" in shown
    assert "count_F_Immg" in shown


def test_values_that_do_not_parse_end_the_run(spark, sources):
    path = sources.cities
    text = open(path).read()
    bad = path.replace("cities", "bad-cities")
    with open(bad, "w") as file:
        file.write(text.replace(";77;", ";12.5;"))
    assert text != open(bad).read()
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        run_all(spark, replace(sources, cities=bad))
    kept = run_all(spark, replace(sources, cities=bad, strict_types=False, output=sources.output + "2"))
    assert kept.cities.where("ForeignBorn is not null").count() == 0


def test_arrivals_by_name_of_file(spark, sources):
    chosen = replace(sources, arrivals=sources.arrivals[0], arrivals_glob="*.parquet")
    assert len(arrival_paths(spark, chosen)) == 1
    assert len(list_files(spark, sources.arrivals[0], "*.csv")) == 0


def test_question_uses_the_partitions_of_the_run(spark, sources):
    run = replace(run_all(spark, sources), partitions=37)
    plan = run.arrivals_by_foreign_born()._jdf.queryExecution().toString()
    assert "37" in plan and rows(run.arrivals_by_foreign_born(with_key=True)) == [(77, 2)]


def test_a_run_that_fails_a_gate_keeps_the_last_tables(spark, sources):
    first = run_all(spark, replace(sources, check_keys=True, check_types=True))
    kept = rows(first.fact.drop("Immig_Fact_ID"))
    with pytest.raises(DataQualityError, match="columns differ"):
        # Nothing gives the elevation its type.
        run_all(spark, replace(sources, check_types=True, airport_types={}))
    with pytest.raises(DataQualityError):
        run_all(spark, replace(sources, arrivals=_only_incomplete(spark, sources)))
    folder = f"{sources.output}/{star.FACT.folder}"
    assert rows(spark.read.schema(first.fact.schema).parquet(folder).select(first.fact.columns).drop("Immig_Fact_ID")) == kept
    assert {f for f in os.listdir(sources.output) if f[0] in "_."} == set()


def test_planted_orphan_ends_the_run(spark, sources, monkeypatch):
    plain = star.arrival_dates

    def one_less(arrivals, distinct=False):
        table = plain(arrivals, distinct)
        lost = table.agg(F.max("ArriveDate")).first()[0]
        return table.where(F.col("ArriveDate") != lost)

    monkeypatch.setattr(star, "arrival_dates", one_less)
    with pytest.raises(DataQualityError, match="ArriveDate.*refers to nothing"):
        run_all(spark, replace(sources, check_keys=True))
    assert not os.path.exists(f"{sources.output}/{star.FACT.folder}")
    run_all(spark, sources)


def test_repeated_natural_key_ends_the_run(spark, sources, monkeypatch):
    plain = star.airports
    monkeypatch.setattr(star, "airports", lambda *a: plain(*a).union(plain(*a)))
    with pytest.raises(DataQualityError, match="AirPortID.*not unique"):
        run_all(spark, replace(sources, check_keys=True))


def test_count_levels(spark):
    df = spark.createDataFrame(
        [("P", "C", 1), ("P", "C", 2), ("Q", "C", 1), (None, "D", None), (None, "D", 1)], "port string, city string, year int"
    )
    found = queries.count_levels(df, [["port", "year"], ["city"], []], ["port", "city", "year"])
    assert rows(found) == rows([
        (0, "P", None, 1, 1), (0, "P", None, 2, 1), (0, "Q", None, 1, 1), (0, None, None, None, 1), (0, None, None, 1, 1),
        (1, None, "C", None, 3), (1, None, "D", None, 2), (2, None, None, None, 5),
    ])
    plan = final_plan(found)
    assert plan.count("Expand") >= 1 and plan.count("Scan ExistingRDD") == plan.count("Expand")
    with pytest.raises(ValueError):
        queries.count_levels(df, [["port"], ["port"]], ["port"])
    with pytest.raises(ValueError):
        queries.count_levels(df, [["lost"]], ["port"])


def test_arrival_details_with_hot_keys(spark, monkeypatch):
    fact = spark.range(200).selectExpr("IF(id % 3 = 0, 0, id) AS cicid_Immigrant", "IF(id % 2 = 0, 'P', 'Q') AS AirPortCode", "id")
    persons = spark.range(100).selectExpr("IF(id % 3 = 0, 0, id) AS cicid_Immigrant", "id AS DepartureDate")
    cities = spark.createDataFrame([("P", 1), ("P", 2), ("Q", 3)], "AirPortCode string, ForeignBorn int")
    wanted = fact.join(persons.withColumnRenamed("DepartureDate", "PersonDepartureDate"), "cicid_Immigrant").join(cities, "AirPortCode")
    found = queries.arrival_details(fact, persons, cities, heavy_rows=10)
    names = sorted(wanted.columns)
    assert rows(found.select(names)) == rows(wanted.select(names))
    monkeypatch.setattr(queries, "fits_broadcast", lambda df: False)
    found = queries.arrival_details(fact, persons, cities, heavy_rows=10)
    assert rows(found.select(names)) == rows(wanted.select(names))
