"""Loading files step by step against loading all at once."""

import math
import random
from dataclasses import replace

import pytest

from keelstone import DataQualityError, Settings
from keelstone.plans import batch, refresh, star
from keelstone.sinks import publish
from keelstone.sources.files import SourceError, exists
from tests.conftest import rows

SCHEMA = (
    "cicid double, i94cit double, i94res double, i94port string, arrdate double, depdate double, i94mode double, "
    "i94addr string, biryear double, gender string, fltno string, matflag string, visatype string, admnum double"
)


def months(spark, folder, seed=3, files=4, n=60):
    """Files of arrivals whose keys, months, visa types and modes overlap."""
    rng = random.Random(seed)
    paths = []
    for f in range(files):
        data = [
            (
                rng.choice([None, 0.0]) if rng.random() < 0.05 else float(rng.randrange(80)),
                rng.choice([None, math.nan]) if rng.random() < 0.1 else float(rng.randrange(5)),
                1.0, rng.choice(["AAA", None]), rng.choice([None, 20545.0 + 20 * f + rng.randrange(30)]), None,
                rng.choice([None, 1.0, 2.0, math.nan]), None, 1980.0, rng.choice("MF"),
                rng.choice([None, "10", "20"]), "M", rng.choice(["B1", "B2", "a/b =c", None, f"only{f}"]), 1.0,
            )
            for _ in range(n)
        ]
        path = f"{folder}/month {f}.parquet"
        spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(path)
        paths.append(path)
    return paths


def settings(paths, output, **more):
    nothing = dict.fromkeys(("cities", "airports", "temperatures", "labels"), "")
    return Settings(arrivals=paths, output=str(output), stable_fact_id=True, check_keys=True, **nothing, **more)


def tables(spark, chosen):
    return [rows(t) for t in refresh.read_arrivals(spark, chosen)]


@pytest.mark.parametrize("distinct", [False, True])
def test_step_by_step_equals_all_at_once(spark, tmp_path, distinct):
    paths = months(spark, tmp_path)
    whole = settings(paths, tmp_path / "whole", distinct_dates=distinct)
    wanted = [rows(t) for t in batch.load_arrivals(spark, whole, batch.StageReport(spark))]
    for name, order in (("forward", paths), ("backward", paths[::-1])):
        chosen = settings(paths, tmp_path / name, distinct_dates=distinct)
        for i in range(len(order)):
            assert refresh.refresh(spark, replace(chosen, arrivals=order[: i + 1])) == [order[i]]
        assert tables(spark, chosen) == wanted
        assert refresh.refresh(spark, chosen) == []
    once = settings(paths, tmp_path / "once", distinct_dates=distinct)
    assert refresh.refresh(spark, once) == paths and tables(spark, once) == wanted


def test_rows_without_a_rival_are_deduplicated_once(spark, tmp_path, monkeypatch):
    def row(cicid, mode):
        return (cicid, 1.0, 1.0, "A", 20600.0 + (cicid or 0), None, mode, None, 1.0, "M", "1", "M", "B1", 1.0)

    paths = []
    for name, data in (("a", [row(1.0, 1.0), row(1.0, 2.0), row(None, 1.0)]), ("b", [row(2.0, 1.0), row(2.0, 1.0)])):
        paths.append(f"{tmp_path}/{name}")
        spark.createDataFrame(data, SCHEMA).write.parquet(paths[-1])
    chosen = settings(paths, tmp_path / "t")

    def fail(*_):
        raise AssertionError("all rows are aggregated again")

    monkeypatch.setattr(refresh.cleaning, "keep_first", fail)
    refresh.refresh(spark, replace(chosen, arrivals=paths[:1]))
    refresh.refresh(spark, chosen)
    dates, fact, persons = tables(spark, chosen)
    assert len(dates) == 5 and sorted(r[1] or 0 for r in fact) == [0, 1, 2] and len(persons) == 3


def test_only_touched_partitions_are_written(spark, tmp_path):
    paths = months(spark, tmp_path, n=12)
    chosen = settings(paths, tmp_path / "t")
    refresh.refresh(spark, replace(chosen, arrivals=paths[:2]))
    folder = tmp_path / "t" / star.FACT.folder
    before = {p.name: p.stat().st_mtime_ns for p in folder.glob("VisaType=only0/*.parquet")}
    only = spark.createDataFrame([(1000.0, 1.0, 1.0, "A", 20700.0, None, 1.0, None, 1.0, "M", "1", "M", "new", 1.0)], SCHEMA)
    only.write.parquet(str(tmp_path / "more"))
    refresh.refresh(spark, replace(chosen, arrivals=[*paths[:2], str(tmp_path / "more")]))
    assert {p.name: p.stat().st_mtime_ns for p in folder.glob("VisaType=only0/*.parquet")} == before
    assert spark.read.parquet(str(folder / "VisaType=new")).count() == 1


def test_a_partition_that_loses_its_last_row_goes(spark, tmp_path):
    row = (1.0, 5.0, 1.0, "A", 20600.0, None, 1.0, None, 1.0, "M", "1", "M", "late", 1.0)
    better = (1.0, 2.0, 1.0, "A", 20650.0, None, 2.0, None, 1.0, "M", None, "M", "early", 1.0)
    paths = []
    for name, data in (("a", [row]), ("b", [better])):
        paths.append(f"{tmp_path}/{name}")
        spark.createDataFrame(data, SCHEMA).write.parquet(paths[-1])
    chosen = settings(paths, tmp_path / "t")
    refresh.refresh(spark, replace(chosen, arrivals=paths[:1]))
    assert [len(t) for t in tables(spark, chosen)] == [1, 1, 1]
    refresh.refresh(spark, chosen)
    dates, fact, persons = tables(spark, chosen)
    # The second row comes first, and has no flight number.
    assert len(dates) == 2 and [r[6] for r in fact] == ["early"] and persons == []
    assert {p.name for p in (tmp_path / "t" / star.FACT.folder).glob("V*")} == {"VisaType=early"}


def test_a_refresh_that_dies_has_not_begun(spark, tmp_path, monkeypatch):
    paths = months(spark, tmp_path)
    chosen = settings(paths, tmp_path / "t")
    refresh.refresh(spark, replace(chosen, arrivals=paths[:2]))
    before = tables(spark, replace(chosen, arrivals=paths[:2]))
    with monkeypatch.context() as patch:
        def fail(*_):
            raise DataQualityError("planted")

        patch.setattr(batch.gates, "check_unique", fail)
        with pytest.raises(DataQualityError, match="planted"):
            refresh.refresh(spark, chosen)
    assert tables(spark, chosen) == before
    assert set(refresh.loaded_files(spark, chosen.output)) == set(paths[:2])
    # Killed in the middle of the swap: the next one finds it committed and finishes it.
    made, plain = [], publish._Files.rename

    def rename(self, source, target):
        if len(made) == 5:
            raise KeyboardInterrupt
        made.append(target)
        plain(self, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(publish._Files, "rename", rename)
        with pytest.raises(KeyboardInterrupt):
            refresh.refresh(spark, chosen)
    assert refresh.refresh(spark, chosen) == []
    whole = settings(paths, tmp_path / "whole")
    refresh.refresh(spark, whole)
    assert tables(spark, chosen) == tables(spark, whole)


def test_odd_refreshes(spark, tmp_path):
    paths = months(spark, tmp_path, files=1)
    chosen = settings(paths, tmp_path / "t")
    with pytest.raises(ValueError):
        refresh.refresh(spark, replace(chosen, stable_fact_id=False))
    refresh.refresh(spark, chosen)
    spark.read.parquet(paths[0]).limit(3).write.parquet(f"{tmp_path}/other")
    spark.read.parquet(f"{tmp_path}/other").write.mode("overwrite").parquet(paths[0])
    with pytest.raises(SourceError, match="changed"):
        refresh.refresh(spark, chosen)
    assert not exists(spark, f"{tmp_path}/t/_next-run")
