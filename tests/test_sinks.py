import glob
import os
import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.operators.gates import DataQualityError, check_unique
from keelstone.sinks import publish
from keelstone.sinks.parquet import write_checked, write_new
from keelstone.sources.files import list_files
from tests.conftest import rows


def test_partition_values_keep_type_and_order(spark, tmp_path):
    df = spark.createDataFrame(
        [(1.0, "a"), (None, "b"), (2.5, "c")], "p double, x string"
    )
    table, count, _ = write_checked(df, str(tmp_path / "t"), "p")
    assert count == 3
    assert table.dtypes == df.dtypes
    assert rows(table) == rows(df)


def test_text_partition_values(spark, tmp_path):
    df = spark.createDataFrame([("x y", 1), ("", 2), ("007", 3), (None, 4)], "p string, n int")
    table = write_checked(df, str(tmp_path / "t"), "p").table
    assert rows(table) == rows(df.replace("", None, "p"))


def test_overwrite_replaces_everything(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(spark.range(5).selectExpr("id", "id % 2 AS p"), path, "p")
    table = write_checked(spark.range(3).selectExpr("id", "7L AS p"), path, "p").table
    assert rows(table) == [(0, 7), (1, 7), (2, 7)]


@pytest.mark.parametrize("partition_by", [None, "p"])
def test_empty_table_fails_the_gate(spark, tmp_path, partition_by):
    empty = spark.range(0).selectExpr("id", "id AS p")
    with pytest.raises(DataQualityError):
        write_checked(empty, str(tmp_path / "t"), partition_by)


def test_few_files_per_value_but_hot_values_are_split(spark, tmp_path, settings):
    df = spark.range(0, 200000, numPartitions=16).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', concat('v', id % 5)) AS p", "sha2(string(id), 256) AS pad"
    )
    write_checked(df, str(tmp_path / "a"), "p")
    assert len(list_files(spark, str(tmp_path / "a" / "p=v1"), "*.parquet")) == 1
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB")
    table, count, _ = write_checked(df, str(tmp_path / "b"), "p")
    assert len(list_files(spark, str(tmp_path / "b" / "p=hot"), "*.parquet")) > 1
    assert count == table.count() == 200000


def test_write_new_refuses_to_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    assert rows(write_new(spark.range(2).toDF("a"), path)) == [(0,), (1,)]
    with pytest.raises(AnalysisException):
        write_new(spark.range(2).toDF("a"), path)


def test_staged_tables_live_in_the_shared_folder(spark):
    root = scratch.shared_root(spark)
    assert scratch.new_folder(spark, "x") != scratch.new_folder(spark, "x")
    staged = scratch.stage(spark.range(3), "numbers")
    assert all(root in path for path in staged.inputFiles())
    assert rows(staged) == [(0,), (1,), (2,)]


def test_dropped_tables_are_deleted(spark):
    kept, gone = scratch.stage(spark.range(3), "kept"), scratch.stage(spark.range(4), "gone")
    folder = gone.inputFiles()[0].removeprefix("file:").rpartition("/")[0].replace("//", "")
    assert os.path.exists(folder)
    scratch.drop(gone)
    assert not os.path.exists(folder) and rows(kept) == [(0,), (1,), (2,)]
    with pytest.raises(KeyError):
        scratch.drop(gone)


def test_staging_leaves_no_shuffles(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for d in disk.localDirs() for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}

    before, setting = shuffles(), spark.conf.get(scratch._CLEANUP)
    counts = spark.range(1000).repartition(3).groupBy(F.expr("id % 7")).count()
    with ThreadPoolExecutor(3) as pool:
        staged = list(pool.map(lambda i: scratch.stage(counts, f"counts-{i}"), range(3)))
    # They are removed in the background, which takes its time on a busy machine.
    for _ in range(300):
        if not shuffles() - before:
            break
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(scratch._CLEANUP) == setting
    assert all(table.count() == 7 for table in staged)


def _session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=conf.get),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_shared_folder_comes_from_the_session():
    named = _session("yarn", **{"spark.checkpoint.dir": "hdfs://x/y/"})
    assert scratch.shared_root(named) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        scratch.shared_root(_session("yarn"))
    with pytest.raises(RuntimeError):
        scratch.shared_root(_session("local-cluster[2,1,1024]"))
    local = _session("local[2]")
    assert scratch.shared_root(local) == scratch.shared_root(local)


def test_append_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        write_checked(spark.range(1), str(tmp_path / "t"), mode="append")


# Publication


def versions(spark, n):
    return spark.range(3).selectExpr("id", f"{n}L AS version", "id % 2 AS p")


def seen(spark, path, name=None):
    return {r.version for r in spark.read.parquet(publish.current(spark, path, name)).collect()}


class Killed(BaseException):
    """Ends a run where no handler of an error sees it."""


def killed_at(monkeypatch, step):
    """End the run before the given rename; return how many were made."""
    made, plain = [], publish._Files.rename

    def rename(self, source, target):
        if len(made) == step:
            raise Killed
        made.append(target)
        plain(self, source, target)

    monkeypatch.setattr(publish._Files, "rename", rename)
    return made


def test_failed_gate_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(versions(spark, 1), path)
    with pytest.raises(DataQualityError):
        write_checked(versions(spark, 2).where("id < 0"), path)
    with pytest.raises(DataQualityError):
        write_checked(versions(spark, 2), path, gates=[lambda t: check_unique(t, ["p"])])
    assert seen(spark, path) == {1}
    assert [f.name for f in tmp_path.iterdir()] == ["t"]


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(versions(spark, 1), path)
    bad = versions(spark, 2).withColumn("version", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_checked(bad, path)
    assert seen(spark, path) == {1}


@pytest.mark.parametrize("step", range(4))
@pytest.mark.parametrize("replace", [publish.TABLE, publish.PARTITIONS])
def test_run_killed_at_any_rename(spark, tmp_path, monkeypatch, step, replace):
    """Readers see the old table before the commit and the new one after it, with or without recovery."""
    path = str(tmp_path / "t")
    write_checked(versions(spark, 1).where("id < 3"), path, "p")
    with monkeypatch.context() as patch:
        made = killed_at(patch, step)
        try:
            write_checked(versions(spark, 2), path, "p", replace=replace)
        except Killed:
            assert len(made) == step
    # The first rename is the commit.
    if step == 0:
        assert seen(spark, path) == {1}
        assert not publish.recover(spark, str(tmp_path), "t")
        assert seen(spark, path) == {1}
    else:
        if replace == publish.TABLE:
            assert seen(spark, path) == ({1} if step == 1 else {2})
        publish.recover(spark, str(tmp_path), "t")
        assert seen(spark, path) == {2} and spark.read.parquet(path).count() == 3
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["t"]
    write_checked(versions(spark, 3), path, "p")
    assert seen(spark, path) == {3}


def test_partitions_without_new_rows_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(versions(spark, 1), path, "p")
    table = write_checked(versions(spark, 2).where("p = 1"), path, "p", replace="partitions").table
    assert rows(table.select("p", "version")) == [(0, 1), (0, 1), (1, 2)]
    with pytest.raises(ValueError):
        write_checked(versions(spark, 2), path, replace="partitions")


def test_tables_of_a_publication_appear_together(spark, tmp_path, monkeypatch):
    base = str(tmp_path)

    def publication(n):
        made = publish.Publication(spark, base)
        for name in ("a", "b"):
            assert made.write(versions(spark, n), name).rows == 3
        return made

    publication(1).commit()
    abandoned = publication(2)
    assert seen(spark, f"{base}/a", "run") == seen(spark, f"{base}/b", "run") == {1}
    abandoned.abandon()
    assert seen(spark, f"{base}/a", "run") == {1}
    for step in range(5):
        with monkeypatch.context() as patch:
            killed_at(patch, step)
            with pytest.raises(Killed):
                publication(10 + step).commit()
        publish.recover(spark, base, "run")
        wanted = {1} if step == 0 else {10 + step}
        assert seen(spark, f"{base}/a", "run") == seen(spark, f"{base}/b", "run") == wanted
    with pytest.raises(DataQualityError):
        publish.Publication(spark, base).commit()


def test_error_mode_refuses_an_existing_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_checked(versions(spark, 1), path, mode="error")
    with pytest.raises(FileExistsError):
        write_checked(versions(spark, 2), path, mode="error")
    assert seen(spark, path) == {1}
