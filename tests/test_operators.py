import glob
import math
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from keelstone import scratch
from keelstone.operators import cleaning, fill, gates, profile, skew
from keelstone.operators.lookup import attach_port_codes, fits_broadcast
from suite import QUERIES
from tests.conftest import final_plan, rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, another key is NULL; copies included."""
    rng = random.Random(7)
    data = []
    for i in range(600):
        key = "hot" if i % 3 == 0 else None if i % 50 == 1 else f"k{rng.randrange(150)}"
        value = rng.choice([None, math.nan, 1.0, 2.0, 3.0])
        data.append((key, i, value))
    return data + data[:20]


@pytest.fixture(scope="module")
def frame(spark, skewed):
    return spark.createDataFrame(skewed, "k string, t int, v double").repartition(6)


def _clean(v):
    return None if v is None or math.isnan(v) else v


def test_drop_missing(frame, skewed):
    known = [r for r in skewed if _clean(r[2]) is not None]
    assert rows(cleaning.drop_missing(frame, ["v"])) == rows(known)
    both = [r for r in known if r[0] is not None]
    assert rows(cleaning.drop_missing(frame)) == rows(both)
    assert cleaning.drop_missing(frame, []).count() == len(skewed)


def test_empty_dedup_keys_are_an_error(frame):
    for keys in ([], "k"):
        with pytest.raises(ValueError):
            cleaning.keep_first(frame, keys)
        with pytest.raises(ValueError):
            cleaning.keep_any(frame, keys)


def test_keep_first_is_deterministic(frame, skewed):
    first = {}
    for key, t, v in skewed:
        if key not in first or t < first[key][0]:
            first[key] = (t, v)
    expected = rows([(k, t, v) for k, (t, v) in first.items()])
    assert rows(cleaning.keep_first(frame, ["k"], ["t"])) == expected
    assert rows(cleaning.keep_first(frame.repartition(3), ["k"])) == expected
    assert cleaning.keep_any(frame, ["k"]).count() == len(first)
    assert rows(cleaning.keep_first(frame, ["k", "t", "v"])) == rows(frame.distinct())


def test_keep_first_reduces_before_the_shuffle(frame):
    plan = final_plan(cleaning.keep_first(frame, ["k"], ["t"]))
    assert "Window" not in plan
    assert "partial_min" in plan.split("Exchange hashpartitioning(k", 1)[1]


@pytest.mark.parametrize("heavy_rows", [10**6, 100, 3, 1])
def test_repeated_rows_with_any_number_of_heavy_keys(frame, skewed, heavy_rows):
    counts = {}
    for r in skewed:
        counts[r[0]] = counts.get(r[0], 0) + 1
    expected = rows([r for r in skewed if counts[r[0]] > 1])
    assert rows(cleaning.repeated_rows(frame, ["k"], heavy_rows=heavy_rows)) == expected


def test_heavy_rows_are_not_shuffled(frame, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    counted = cleaning.key_counts(frame, ["k"], "n")
    heaviest = counted.agg({"n": "max"}).first()[0]
    joined = skew.semi_join(frame, counted, ["k"], "n", heavy_rows=heaviest - 1)
    assert joined.count() == frame.count()
    plan = final_plan(joined)
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" in plan


def test_duplicate_counts(frame, skewed):
    assert profile.repeated_row_count(frame).first()[0] == 40
    assert tuple(profile.surplus_rows(frame).first()) == (620, 600, 20)
    keys = {r[0] for r in skewed}
    assert tuple(profile.surplus_rows(frame, ["k"]).first()) == (620, len(keys), 620 - len(keys))
    empty = frame.where("false")
    assert tuple(profile.surplus_rows(empty).first()) == (0, 0, 0)
    assert profile.repeated_row_count(empty).first()[0] == 0
    assert tuple(profile.surplus_per_column(empty).first()) == (0, 0, 0)


def _filled(data, forward):
    result, last = [], {}
    for key, t, v in sorted(data, key=lambda r: r[1], reverse=not forward):
        if _clean(v) is not None:
            last[key] = v
        result.append((key, t, last.get(key)))
    return rows(result)


@pytest.mark.parametrize("max_group_rows", [10**6, 10])
@pytest.mark.parametrize("forward", [True, False])
def test_fill_equals_brute_force(spark, skewed, forward, max_group_rows):
    data = skewed[:600]  # without the copies t is a total order
    df = spark.createDataFrame(data, "k string, t int, v double").repartition(5)
    got = fill.fill(df, "v", ["k"], ["t"], forward, max_group_rows)
    assert got.columns == df.columns
    assert rows(got) == _filled(data, forward)


def test_fill_cuts_a_large_key(spark):
    df = spark.range(4000).selectExpr("'one' AS k", "id AS t", "IF(id = 3, 7D, NULL) AS v")
    got = fill.fill_forward(df, "v", ["k"], ["t"], max_group_rows=100)
    assert got.where("v = 7").count() == 3997
    assert "_chunk" in final_plan(got)


@pytest.mark.parametrize("forward", [True, False])
def test_fill_carries_values_at_null_places(spark, settings, forward):
    settings(spark__sql__shuffle__partitions="8")
    data = [("k", None, 5.0)] + [("k", t, 9.0 if t == 1500 else None) for t in range(2000)]
    df = spark.createDataFrame(data, "k string, t int, v double").repartition(3)
    plain = fill.fill(df, "v", ["k"], ["t"], forward)
    cut = fill.fill(df, "v", ["k"], ["t"], forward, max_group_rows=500)
    assert rows(cut) == rows(plain)
    assert cut.where("v = 5").count() == (1500 + 1 if forward else 1)


def test_chunks_are_many_and_bounded(spark, monkeypatch):
    seen = []
    checkpoint = fill.scratch.checkpoint
    monkeypatch.setattr(fill.scratch, "checkpoint", lambda df: seen.append(checkpoint(df)) or seen[-1])
    df = spark.range(4000).selectExpr("'one' AS k", "id AS t", "IF(id = 3, 7D, NULL) AS v")
    fill.fill_forward(df, "v", ["k"], ["t"], max_group_rows=500).count()
    sizes = [r["count"] for r in seen[0].groupBy("_chunk").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 500


def test_fill_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "k string, t int, v double")
    assert fill.fill_forward(df, "v", ["k"], ["t"]).count() == 0


def test_clean_report(frame, skewed):
    cleaned = cleaning.clean(frame, ["v"], ["k"])
    known = [r for r in skewed if _clean(r[2]) is not None]
    keys = {r[0] for r in known}
    assert dict(cleaned.report.collect()) == {
        "rows_in": len(skewed),
        "missing_dropped": len(skewed) - len(known),
        "duplicates_dropped": len(known) - len(keys),
        "rows_out": len(keys),
    }
    assert cleaned.frame.count() == len(keys)
    assert cleaning.clean(frame, ["v"]).frame.count() == len(known)


def _lookup_frames(spark):
    ports = spark.createDataFrame(
        [("1", "A", "X"), ("2", "A", "Y"), ("3", "B", "X")],
        "PortCode string, CityName string, StateCode string",
    )
    return spark.createDataFrame([("a", "X"), ("C", "X"), (None, "X")], "c string, s string"), ports


@pytest.mark.parametrize("max_rows", [100, 0])
def test_lookup_fans_out_and_keeps_all_rows(spark, max_rows):
    df, ports = _lookup_frames(spark)
    found = attach_port_codes(df, ports, F.upper("c"), max_rows=max_rows)
    assert rows(found.select("AirPortCode", "c")) == [
        ("1", "a"), ("2", "a"), (None, "C"), (None, None),
    ]
    exact = attach_port_codes(df, ports, F.col("c"), max_rows=max_rows)
    assert exact.where("AirPortCode IS NOT NULL").count() == 0
    two = attach_port_codes(df, ports, F.upper("c"), F.col("s"), max_rows=max_rows)
    assert rows(two.select("AirPortCode", "c")) == [("1", "a"), (None, "C"), (None, None)]


def test_dictionary_size_is_measured(spark):
    df = spark.range(10).selectExpr("repeat('x', 100) AS s")
    assert fits_broadcast(df, 10, 1080)
    assert not fits_broadcast(df, 9, 10**6)
    assert not fits_broadcast(df, 10, 1079)
    assert fits_broadcast(df.where("false"))


def test_large_dictionary_splits_a_hot_city(spark, settings):
    settings(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
    )
    df = spark.range(0, 60000, numPartitions=12).selectExpr(
        "id", "IF(id % 3 = 0, 'HOT', concat('CITY ', id)) AS c"
    )
    ports = spark.range(0, 60000, 100).selectExpr(
        "concat('P', id) AS PortCode", "IF(id = 0, 'HOT', concat('CITY ', id)) AS CityName",
        "'S' AS StateCode",
    )
    found = attach_port_codes(df, ports, F.col("c"), max_rows=0)
    assert "skew=true" in final_plan(found)
    assert found.count() == 60000
    assert found.where("AirPortCode IS NOT NULL").count() == 20000 + 400


@pytest.mark.parametrize("before, after", [(0, 5), (5, 0), (0, 0), (5, 4)])
def test_count_gate_refuses(before, after):
    with pytest.raises(gates.DataQualityError):
        gates.check_row_counts(before, after)


def test_count_gate_passes():
    gates.check_row_counts(5, 5)


def test_key_and_type_gates(frame):
    with pytest.raises(gates.DataQualityError, match="hot"):
        gates.check_unique(frame, ["k"])
    gates.check_unique(frame.distinct(), ["t"])
    gates.check_types(frame.select("v", "t", "k"), frame.schema)
    with pytest.raises(gates.DataQualityError, match="'t': \\('int', 'bigint'\\)"):
        gates.check_types(frame.withColumn("t", F.col("t").cast("long")), frame.schema)
    with pytest.raises(gates.DataQualityError):
        gates.check_types(frame.drop("v"), frame.schema)


def test_orphans(spark, settings):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (2, "a"), (None, "a"), (3, None)], "x int, y string")
    parent = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (7, "b")], "k int, j string")
    for rows_that_fit in (500_000, 0):
        found = gates.orphans(child, ["x"], parent, ["k"], rows_that_fit)
        assert rows(found) == [(2, 2), (3, 1)]
        assert rows(gates.orphans(child, ["x", "y"], parent, ["k", "j"], rows_that_fit)) == [(1, "b", 1), (2, "a", 2)]
    gates.check_references(child.where("x = 1"), ["x"], parent, ["k"])
    with pytest.raises(gates.DataQualityError, match="'x': 2"):
        gates.check_references(child, ["x"], parent, ["k"])
    gates.check_references(child.limit(0), ["x"], parent.limit(0), ["k"])


def _counts(df, *args):
    kept = cleaning.Counted(df, *args)
    return kept.counts(), kept.frame


def test_counts_are_data(spark):
    df = spark.createDataFrame(
        [(1.0, "b"), (1.0, "a"), (1.0, "a"), (float("nan"), "c"), (None, "d"), (2.0, None)], "k double, x string"
    )
    counts, frame = _counts(df, ["k"], ["k"])
    assert counts == {"rows_in": 6, "missing_dropped": 2, "duplicates_dropped": 2, "rows_out": 2}
    assert frame.dtypes == df.dtypes and rows(frame) == [(1.0, "a"), (2.0, None)]
    assert rows(frame) == rows(cleaning.clean(df, ["k"], ["k"]).frame)
    counts, frame = _counts(df, ["x"])
    assert counts == {"rows_in": 6, "missing_dropped": 1, "duplicates_dropped": 0, "rows_out": 5}
    assert rows(frame) == rows(df.where("x is not null"))
    counts, frame = _counts(df, (), ["k", "x"])
    assert counts == {"rows_in": 6, "missing_dropped": 0, "duplicates_dropped": 1, "rows_out": 5}
    for keys in (None, ["k"]):
        counts, frame = _counts(df.limit(0), ["k"], keys)
        assert set(counts.values()) == {0} and frame.count() == 0


def test_rows_without_a_key_and_lost_rows_are_told_apart(spark):
    data = [(None, "b", 1), (None, "a", None), (None, None, 0), (1.0, None, 0), (2.0, None, 5), (1.0, "c", None), (1.0, "c", 7)]
    df = spark.createDataFrame(data, "k double, x string, n int")
    counts, frame = _counts(df, ["x"], ["k"])
    assert counts == {"rows_in": 7, "missing_dropped": 3, "duplicates_dropped": 2, "rows_out": 2}
    assert rows(frame) == rows([(None, "a", None), (1.0, "c", None)])
    # All rows are lost: no key is left, not even NULL.
    counts, frame = _counts(df.where("x is null"), ["x"], ["k"])
    assert counts == {"rows_in": 3, "missing_dropped": 3, "duplicates_dropped": 0, "rows_out": 0} and frame.count() == 0


def test_counted_cleaning_sorts_by_its_key_alone(spark):
    df = spark.range(50).selectExpr("double(id % 9) AS k", "string(id) AS x")
    plan = final_plan(cleaning.Counted(df, ["k"], ["k"])._reduced())
    sorts = [line for line in plan.splitlines() if " Sort [" in line]
    assert sorts and all(line.count(" ASC") == 1 for line in sorts)


def test_counts_when_a_map_task_runs_again(spark, settings, tmp_path, monkeypatch):
    """One map output is lost after its task has ended; the map task runs again for the later readers."""
    settings(spark__sql__adaptive__enabled="false", spark__sql__shuffle__partitions="40")
    df = spark.range(4000).selectExpr("id % 900 AS k", "IF(id % 7 = 0, NULL, id) AS x").repartition(4).cache()
    df.count()
    plain, again = scratch.stage, tmp_path / "ran"
    again.mkdir()
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    own = [d.getPath() for d in disk.localDirs()]

    def lose(batches):
        for i, batch in enumerate(batches):
            # The first reader deletes one map output that the others still need.
            if not (again / "lost").exists():
                (again / "lost").touch()
                found = [f for d in own for f in glob.glob(f"{d}/*/shuffle_*_0.data")]
                os.remove(max(found, key=os.path.getmtime))
            yield batch

    def count(batches):
        (again / uuid.uuid4().hex).touch()
        yield from batches

    def sabotaged(frame, label):
        return plain(frame.mapInArrow(lose, frame.schema), label)

    monkeypatch.setattr(scratch, "stage", sabotaged)
    counts, frame = _counts(df.mapInArrow(count, df.schema), ["x"], ["k"])
    lost = df.where("x is null").count()
    assert (again / "lost").exists() and len(list(again.iterdir())) > 1 + 4
    assert counts == {
        "rows_in": 4000, "missing_dropped": lost, "duplicates_dropped": 4000 - lost - 900, "rows_out": 900
    }
    assert frame.count() == 900


# Joins on hot keys


def _pairs(left, right):
    by = {}
    for k, *rest in right:
        by.setdefault(k, []).append(rest)
    return sorted(((k, *rest, *other) for k, *rest in left if k is not None for other in by.get(k, [])), key=repr)


@pytest.mark.parametrize("heavy_rows", [3, 20, 1000])
def test_inner_join_with_hot_keys(spark, heavy_rows):
    left = [("hot" if i % 3 == 0 else None if i % 20 == 1 else f"k{i % 30}", i % 50, math.nan if i % 7 == 0 else None) for i in range(180)]
    right = [("hot" if i % 3 == 0 else None if i % 20 == 1 else f"k{i % 40}", None if i % 5 == 0 else f"v{i}") for i in range(120)]
    # Equal rows on both sides.
    left, right = left + left[:60], right + [("hot", "same")] * 30 + [("k1", "same")] * 9
    a = spark.createDataFrame(left, "k string, n int, x double").repartition(3)
    b = spark.createDataFrame(right, "k string, v string").repartition(4)
    found = skew.inner_join(a, b, ["k"], heavy_rows)
    assert found.columns == ["k", "n", "x", "v"]
    nan = lambda data: [tuple("NaN" if v != v else v for v in row) for row in data]
    assert rows(found) == sorted(nan(_pairs(left, right)), key=repr)


def test_no_cell_of_a_hot_join_is_large(spark):
    left = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS a", "id % 2 AS b")
    right = spark.range(3_000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS c", "id AS d")
    heavy = skew.key_weights(left, right, ["k"], 500)
    assert rows(heavy) == [(0, 20, 2)]
    own = skew._cells(left, heavy, ["k"], "_left", "_right", ("_i", "_j"), "_times", 500)
    sizes = own.groupBy("_i", "_j").count().agg(F.count("*"), F.max("count"), F.sum("count")).first()
    assert sizes[0] == 40 and sizes[1] < 700 and sizes[2] == 20_000
    # All rows alike: their copies are shared out as well.
    alike = spark.range(10_000).selectExpr("0L AS k", "1 AS a")
    heavy = skew.key_weights(alike, right, ["k"], 500)
    own = skew._cells(alike, heavy, ["k"], "_left", "_right", ("_i", "_j"), "_times", 500)
    assert own.agg(F.max("_times"), F.sum("_times")).first()[:] == (500, 20_000)


def test_inner_join_of_odd_frames(spark):
    a = spark.createDataFrame([(1, 2)], "k int, a int")
    with pytest.raises(ValueError):
        skew.inner_join(a, a, ["k"])
    b = a.withColumnRenamed("a", "b")
    assert skew.inner_join(a.limit(0), b, ["k"], 1).collect() == []
    assert rows(skew.inner_join(a.union(a), b, ["k"], 1)) == [(1, 2, 2), (1, 2, 2)]


def test_pair_sums_equal_those_of_the_joined_rows(spark):
    left = [("hot" if i % 3 == 0 else None if i % 20 == 1 else f"k{i % 30}", None if i % 4 == 1 else i, 0.5 * i) for i in range(120)]
    right = [("hot" if i % 2 == 0 else None if i % 20 == 1 else f"k{i % 40}", None if i % 5 == 0 else -i) for i in range(90)]
    # Equal rows, and a key whose values are all missing.
    left, right = left + left[:40] + [("none", None, 1.0)] * 2, right + right[:9] + [("none", 1)] * 3
    a = spark.createDataFrame(left, "k string, n int, x double").repartition(3)
    b = spark.createDataFrame(right, "k string, v long").repartition(4)
    found = skew.pair_sums(a, b, ["k"], "pairs", {"ns": "n", "xs": "x"}, {"vs": "v"})
    joined = a.join(b, "k").groupBy("k").agg(
        F.count("*").alias("pairs"), F.sum("n").alias("ns"), F.sum("x").alias("xs"), F.sum("v").alias("vs")
    )
    assert found.dtypes == joined.dtypes and rows(found) == rows(joined)
    assert ("none", 6, None, 6.0, 6) in rows(found)


def test_the_query_of_hot_keys_never_forms_their_pairs(spark, tmp_path):
    size = 300_000
    numbers = spark.range(size)
    numbers.selectExpr("id AS o_orderkey", "id AS o_custkey").write.parquet(f"{tmp_path}/orders.parquet")
    numbers.selectExpr("id AS c_custkey", "1 AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["join_hot_key"](spark, str(tmp_path))
    hot = size // 3
    assert rows(found.where("k = 0")) == [(0, hot * hot, 3 * (hot * (hot - 1) // 2) * hot, hot * hot)]
    assert found.count() == 1 + (size - hot)


# Fingerprints


def test_wide_duplicates_equal_plain_counts(spark):
    data = [(i % 40, None if i % 3 else "x", math.nan if i % 4 else None, i % 2) for i in range(200)]
    data += [(1000 + i, None, None, 0) for i in range(50)] + [(None, 1, None, 0)] + [(1, None, None, 0), (None, None, 1.0, 0)]
    df = spark.createDataFrame([(a, str(b) if b is not None else None, c, d) for a, b, c, d in data], "a int, b string, c double, d int")
    groups = df.groupBy(*df.columns).count()
    assert profile.repeated_row_count(df).first()[0] == groups.where("count > 1").agg(F.sum("count")).first()[0]
    n, k = df.count(), groups.count()
    assert tuple(profile.surplus_rows(df).first()) == (n, k, n - k)
    listed = df.join(groups.where("count > 1").drop("count"), [df[c].eqNullSafe(groups[c]) for c in df.columns], "left_semi")
    assert rows(cleaning.repeated_rows(df, df.columns)) == rows(listed)
    assert rows(cleaning.repeated_rows(df, df.columns, heavy_rows=2)) == rows(listed)


def test_fingerprints_that_collide_are_told_apart(spark, monkeypatch):
    """With a fingerprint that is the same for all rows the results stay."""
    monkeypatch.setattr(profile.keys, "fingerprint", lambda names: [F.lit(1).alias("_fp_0"), F.lit(2).alias("_fp_1")])
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (1, 2, 4)], "a int, b int, c int")
    assert profile.repeated_row_count(df).first()[0] == 2
    assert tuple(profile.surplus_rows(df).first()) == (3, 2, 1)
    assert rows(cleaning.repeated_rows(df, ["a", "b", "c"])) == [(1, 2, 3)] * 2


def test_rows_that_occur_once_are_shuffled_as_fingerprints(spark):
    df = spark.range(1000).selectExpr("id AS a", "repeat('x', 200) AS b", "string(id) AS c")
    plan = profile._fingerprint_counts(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    exchange = [line for line in plan.splitlines() if "Exchange" in line][0]
    assert exchange.count("_groupingexpression") == 2 and "[a#" not in exchange and "b#" not in exchange
    assert profile._candidates(df, df.columns).count() == 0


def test_exploration_of_all_types_in_one_scan(spark):
    df = spark.sql(
        """
        SELECT IF(id = 3, NULL, CAST(id % 4 AS TINYINT)) AS a, id > 5 AS b, date'2020-01-01' + CAST(id % 3 AS INT) AS c,
               timestamp_micros(id % 7) AS d, CAST(id / 4 AS DECIMAL(9,2)) AS e, CAST(string(id % 2) AS BINARY) AS f,
               IF(id % 2 = 0, -0.0D, 0.0D) AS g, IF(id % 5 = 0, double('NaN'), IF(id % 5 = 1, NULL, 1.5D)) AS h,
               array(id % 3, NULL) AS i, CAST('2020-10-25 01:30:00' AS TIMESTAMP_NTZ) AS `j.k`, NULL AS l,
               CAST(NULL AS STRING) AS m, IF(id % 3 = 0, '', 'x') AS n
        FROM range(20)
        """
    )
    found = {r.column_name: tuple(r)[1:] for r in profile.exploration_report(df).collect()}
    assert list(found) and set(found) == set(df.columns)
    assert found == {n: tuple(profile._column_facts(df, n).first())[1:] for n in df.columns}
    assert found["g"][1:] == (0, 20, 1) and found["h"][1:] == (8, 16, 2) and found["m"][1:] == (20, 0, 0)
    # Two instants that have one local time in autumn are two values.
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        hours = spark.sql("SELECT timestamp_seconds(1603584000 + 3600 * id) AS t FROM range(3)")
        assert profile.exploration_report(hours).first()["distinct_values"] == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    empty = profile.exploration_report(df.limit(0))
    assert {tuple(r)[2:] for r in empty.collect()} == {(0, 0, 0)}


def test_exploration_reads_a_source_once(spark, tmp_path):
    spark.range(100).selectExpr("id", "id % 3 AS x", "string(id % 5) AS y").write.option("header", True).csv(str(tmp_path / "t"))
    source = spark.read.option("header", True).csv(str(tmp_path / "t"))
    report = profile.exploration_report(source)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert rows(report.select("column_name", "distinct_values")) == [("id", 100), ("x", 3), ("y", 5)]
