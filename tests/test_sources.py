import gzip
import uuid

import pytest

from keelstone.sources import labels
from keelstone.sources.delimited import header_lines, read_delimited, unparsable
from keelstone.sources.files import (
    SourceError, list_files, read_many, total_bytes, within_budget,
)
from tests.conftest import rows

LABELS = "\r\n".join(
    [
        "proc format ;",
        "",
        "  value i94cntyl",
        "   582 =  'MEXICO; Air = Sea'",
        "   236 =  'AFGHANISTAN' ;",
        "",
        "/* ports = codes */",
        "  value $i94prtl",
        "   'ANC'\t=\t'ANCHORAGE, AK         '",
        "   'HOM'\t=\t'HOMER, AK             '           ",
        "   'WAS'\t=\t'WASHINGTON DC         '",
        "   'HAL'\t=\t'Halifax, NS, Canada   '",
        "   'LIA'\t=\t'LITTLE ROCK, AR (BPS)'",
        "   'CP '\t=\t'No PORT Code (CP)'",
        ";",
        "",
        "value i94model",
        "\t1 = 'Air'",
        "\t9 = 'Not reported' ;",
        "value i94addrl",
        "\t'AL'='ALABAMA'",
        "\t'99'='All Other Codes' ;",
        "",
    ]
)
PORTS = [
    ("ANC", "ANCHORAGE", "AK"),
    ("CP ", "UnknownCity", "UnknownState"),
    ("HAL", "Halifax", "NS"),
    ("HOM", "HOMER", "AK"),
    ("LIA", "LITTLE ROCK", "AR (BPS)"),
    ("WAS", "UnknownCity", "UnknownState"),
]


@pytest.fixture(params=["whole", "split"])
def label_file(request, tmp_path, settings):
    """The label file read as one input split, and as many small ones."""
    if request.param == "split":
        settings(spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="1")
    path = tmp_path / "labels.txt"
    path.write_bytes(LABELS.encode())
    return str(path)


def test_lines_are_numbered(spark, label_file, request):
    lines = labels.read_lines(spark, label_file)
    numbered = {r.line_no: r.line for r in lines.collect()}
    assert numbered == dict(enumerate(LABELS.split("\r\n")[:-1], start=1))
    splits = lines.select("split").distinct().count()
    assert splits == 1 if "whole" in request.node.name else splits > 5


def test_port_section(spark, label_file):
    assert rows(labels.read_ports(spark, label_file)) == PORTS


def test_port_line_range(spark, label_file):
    got = labels.read_ports(spark, label_file, line_range=(9, 13))
    assert rows(got) == [p for p in PORTS if p[0] in ("HOM", "WAS", "HAL", "LIA")]


@pytest.mark.parametrize(
    "section, expected",
    [
        # Only the first '=' divides a line.
        (labels.COUNTRY_SECTION, [("236", "AFGHANISTAN"), ("582", "MEXICO; Air = Sea")]),
        (labels.MODE_SECTION, [("1", "Air"), ("9", "Not reported")]),
        (labels.STATE_SECTION, [("99", "All Other Codes"), ("AL", "ALABAMA")]),
        ("nosuch", []),
    ],
)
def test_other_sections(spark, label_file, section, expected):
    got = rows(labels.read_section(spark, label_file, section))
    assert got == expected


def test_sections_of_several_files(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text(f"value $i94prtl\n'{name}' = 'X, Y'\n;\n'{name}2' = 'Z, Y'\n")
    assert rows(labels.read_ports(spark, str(tmp_path))) == [("a", "X", "Y"), ("b", "X", "Y")]


def test_list_files_skips_folders_and_filters(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x")
    (tmp_path / "a.csv").write_text("x")
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("x")
    names = [p.rsplit("/", 1)[1] for p in list_files(spark, str(tmp_path))]
    assert names == ["a.csv", "a.txt", "b.csv"]
    assert [p.rsplit("/", 1)[1] for p in list_files(spark, str(tmp_path), "*.txt")] == ["a.txt"]


def test_total_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a").write_text("12")
    (tmp_path / "sub" / "b").write_text("345")
    assert total_bytes(spark, [str(tmp_path)]) == 5
    assert total_bytes(spark, [str(tmp_path / "a"), str(tmp_path / "sub")]) == 5


@pytest.mark.parametrize("limit, count", [(1, 1), (2, 2), (None, 3), (0, 3), (-1, 3), (9, 3)])
def test_file_budget(limit, count):
    assert within_budget(["c", "a", "b"], limit) == ["a", "b", "c"][:count]


def test_no_files_is_an_error():
    with pytest.raises(SourceError):
        within_budget([], 1)


def _csv(path, text):
    path.write_text(text)
    return str(path)


def test_read_many_aligns_by_name(spark, tmp_path):
    paths = [
        _csv(tmp_path / "1.csv", "a,b\n1,x\n"),
        _csv(tmp_path / "2.csv", "b,extra,a\ny,0,2\n"),
        _csv(tmp_path / "3.csv", "a,b\n3,z\n3,z\n"),
    ]
    got = read_many(spark, paths, "csv", options={"header": "true"})
    assert got.columns == ["a", "b"]
    assert rows(got) == [("1", "x"), ("2", "y"), ("3", "z"), ("3", "z")]
    assert rows(read_many(spark, paths, "csv", 1, {"header": "true"})) == [("1", "x")]


def test_read_many_names_the_missing_column(spark, tmp_path):
    paths = [_csv(tmp_path / "1.csv", "a,b\n1,x\n"), _csv(tmp_path / "2.csv", "a\n1\n")]
    with pytest.raises(SourceError, match=r"2\.csv.*\['b'\]"):
        read_many(spark, paths, "csv", options={"header": "true"})


def test_read_many_has_one_input_per_layout(spark, tmp_path):
    for i in range(4):
        spark.range(i, i + 1).write.parquet(str(tmp_path / str(i)))
    got = read_many(spark, [str(tmp_path / str(i)) for i in range(4)])
    assert rows(got) == [(0,), (1,), (2,), (3,)]
    assert "Union" not in got._jdf.queryExecution().optimizedPlan().toString()
    schema = got.schema
    trusted = read_many(spark, [str(tmp_path / "2"), str(tmp_path / "1")], schema=schema)
    assert rows(trusted) == [(1,), (2,)]


def test_delimited_forms(spark, tmp_path):
    path = _csv(tmp_path / "x.csv", "name;n;d\na;1;2.5\nb;;\n")
    typed = read_delimited(spark, path, ";", types={"n": "int", "d": "double"})
    assert typed.dtypes == [("name", "string"), ("n", "int"), ("d", "double")]
    assert rows(typed) == [("a", 1, 2.5), ("b", None, None)]
    assert read_delimited(spark, path, ";", infer=True).dtypes == typed.dtypes
    raw = read_delimited(spark, path, ";", header=False)
    assert raw.columns == ["_c0", "_c1", "_c2"] and raw.count() == 3
    with pytest.raises(ValueError, match="nosuch"):
        read_delimited(spark, path, ";", types={"nosuch": "int"})


def test_sources_without_multi_path_schemas_are_read_one_by_one(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_text(name * 3)
    got = read_many(spark, list_files(spark, str(tmp_path)), "binaryFile")
    assert rows(got.selectExpr("cast(content AS string)", "length")) == [("aaa", 3), ("bbb", 3)]


def test_headers_in_two_orders_are_aligned(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n10;20\n")
    (tmp_path / "b.csv").write_text("y;x\n20;10\n")
    for types in (None, {"x": "int", "y": "int"}):
        df = read_delimited(spark, str(tmp_path), ";", types=types)
        assert df.columns == ["x", "y"] and [tuple(map(int, r)) for r in df.collect()] == [(10, 20)] * 2
    (tmp_path / "c.csv").write_text("x;z\n1;2\n")
    with pytest.raises(SourceError, match="y"):
        read_delimited(spark, str(tmp_path), ";")


def test_values_that_do_not_parse_are_counted(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,a\n12.5,b\n,c\n\"1,200\",d\n")
    path = str(tmp_path)
    assert rows(unparsable(spark, path, {"n": "int"})) == [("n", 2)]
    assert read_delimited(spark, path, types={"n": "int"}).where("n is null").count() == 3
    with pytest.raises(Exception, match="(?i)malformed"):
        read_delimited(spark, path, types={"n": "int"}, strict=True).collect()


def test_columns_align_whatever_their_case(spark, tmp_path):
    spark.range(1).selectExpr("id AS cicid").write.parquet(str(tmp_path / "a"))
    spark.range(1, 2).selectExpr("id AS CICID").write.parquet(str(tmp_path / "b"))
    df = read_many(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert df.columns == ["cicid"] and rows(df) == [(0,), (1,)]


def _jobs(spark, work):
    """Result of `work` and the number of jobs it ran."""
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize("count", [3, 90])
def test_headers_of_many_files_cost_as_many_jobs_as_of_few(spark, tmp_path, count):
    folder = tmp_path / "some files%20x"
    folder.mkdir()
    for i in range(count):
        columns = ["id", "name", "n"] if i % 3 else ["n", "id", "name"]
        values = {"id": str(i), "name": f'"x, {i}"', "n": str(i * 10)}
        rest = [",".join(values[c] for c in columns)] * 50
        (folder / f"part {i:03}.csv").write_text("\n \n" * (i % 2) + "\n".join([",".join(columns), *rest]) + "\n")
    (folder / "part-empty.csv").write_text("")
    files = list_files(spark, str(folder))
    groups, jobs = _jobs(spark, lambda: header_lines(spark, files))
    assert {k: len(v) for k, v in groups.items()} == {"n,id,name": -(-count // 3), "id,name,n": count - -(-count // 3)}
    assert jobs <= 1 + (count > 32)  # the listing of many paths is a job as well
    types = {"id": "int", "n": "int"}
    table, jobs = _jobs(spark, lambda: read_delimited(spark, str(folder), types=types))
    assert table.columns == ["n", "id", "name"] and jobs <= 6
    assert rows(table.distinct()) == sorted([(i * 10, i, f"x, {i}") for i in range(count)], key=repr)
    assert table.count() == 50 * count


def test_headers_stop_at_the_first_line(spark, tmp_path):
    """A large file is not read for its header, and packed files are."""
    (tmp_path / "a.csv").write_text("x;y\n" + "1;2\n" * 400_000)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as file:
        file.write("y;x\n4;3\n")
    groups = header_lines(spark, list_files(spark, str(tmp_path)))
    assert sorted(groups) == ["x;y", "y;x"]
    table = read_delimited(spark, str(tmp_path), ";", types={"x": "int", "y": "int"})
    assert rows(table.distinct()) == [(1, 2), (3, 4)]
    assert header_lines(spark, []) == {}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") != str(1 << 50)
