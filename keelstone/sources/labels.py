"""Label dictionaries: text files with ``value <name>`` sections.

A section lists ``'code' = 'label'`` lines and ends at a semicolon. Finding
the section of a line needs the lines before it, and parity with a fixed cut
needs line numbers. Both are derived per input split and then carried from one
split to the next, so no task ever holds more than one split of a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from keelstone.functions import text
from keelstone.operators.fill import carry_last

# Section names of the label file and the 0-based, half-open
# line range that yields the 590 port entries joined downstream.
COUNTRY_SECTION = "i94cntyl"
PORT_SECTION = "i94prtl"
MODE_SECTION = "i94model"
STATE_SECTION = "i94addrl"
PORT_LINE_RANGE = (303, 893)

_HEADER = r"(?i)^\s*value\s+\$?(\w+)"
_ENTRY = r"^\s*('[^']*'|-?[0-9.]+)\s*="
_LABEL_QUOTED = r"'[^']*'"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, input split, and 1-based number within the file."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    in_split = Window.partitionBy("file", "split").orderBy("_seq")
    numbered = lines.withColumn("_pos", F.row_number().over(in_split)).drop("_seq")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        lines.groupBy("file", "split")
        .agg(F.count(F.lit(1)).alias("_lines"))
        .withColumn("_offset", F.coalesce(F.sum("_lines").over(earlier), F.lit(0)))
        .drop("_lines")
    )
    return numbered.join(offsets, ["file", "split"]).select(
        "file", "split", (F.col("_offset") + F.col("_pos")).alias("line_no"), "line"
    )


def entries(lines: DataFrame, line: str = "line") -> DataFrame:
    """Replace text lines by their (code, label); other columns stay."""
    others = [c for c in lines.columns if c != line]
    return lines.where(F.col(line).contains("=")).select(
        *others,
        text.label_code(F.col(line)).alias("code"),
        text.label_text(F.col(line)).alias("label"),
    )


def read_section(spark: SparkSession, path: str | list[str], section: str) -> DataFrame:
    """(code, label) of every entry in the sections called `section`."""
    lines = read_lines(spark, path)
    name = F.regexp_extract("line", _HEADER, 1)
    closes = F.regexp_replace("line", _LABEL_QUOTED, "").contains(";")
    marked = lines.withColumn(
        "_mark", F.when(name != "", F.lower(name)).when(closes, F.lit(""))
    )
    # An entry belongs to the nearest mark above it; a closing line carries the
    # mark "" for the lines below only.
    placed = carry_last(
        marked, "_mark", keys=["file"], chunk="split", order=["line_no"],
        into="_section", inclusive=False,
    )
    inside = placed.where(
        (F.col("_section") == section.lower()) & F.col("line").rlike(_ENTRY)
    )
    # The last entry may share its line with the closing semicolon.
    return entries(inside.select(F.regexp_replace("line", r"'\s*;\s*$", "'").alias("line")))


def read_line_range(spark: SparkSession, path: str, line_range: tuple[int, int]) -> DataFrame:
    """(code, label) of the entries on lines [start, stop), counted from 0."""
    start, stop = line_range
    lines = read_lines(spark, path).where(
        (F.col("line_no") > start) & (F.col("line_no") <= stop)
    )
    return entries(lines.select("line"))


def to_ports(labels: DataFrame) -> DataFrame:
    """(code, label) to (PortCode, CityName, StateCode)."""
    city, state = text.city_and_state(F.col("label"))
    return labels.select(
        F.col("code").alias("PortCode"), city.alias("CityName"), state.alias("StateCode")
    )


def read_ports(
    spark: SparkSession,
    path: str | list[str],
    section: str = PORT_SECTION,
    line_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Port dictionary, from a named section or from a fixed line range."""
    labels = (
        read_section(spark, path, section)
        if line_range is None
        else read_line_range(spark, path, line_range)
    )
    return to_ports(labels)
