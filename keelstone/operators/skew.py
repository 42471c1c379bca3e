"""Joins that stay balanced when a few keys hold most rows.

Keys with more rows than one task should hold are found by a pre-aggregated
count. If there are any, and their table is measured to fit a broadcast, their
rows take another way than the ordinary shuffle join of all others: a semi join
keeps them by that broadcast, an inner join deals them out to a grid of cells.
Both parts together are the whole result. Counts and sums over the pairs of a
join need no pairs and so no such way: `pair_sums`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from keelstone import scratch
from keelstone.functions.keys import hash_parts
from keelstone.functions.missing import column
from keelstone.operators.lookup import measure

# Keys with more rows than this are heavy.
HEAVY_ROWS = 1_000_000


def _matches(keys: Sequence[str]):
    return reduce(
        lambda a, b: a & b, [column(k).eqNullSafe(F.col(f"_on_{i}")) for i, k in enumerate(keys)]
    )


def semi_join(
    df: DataFrame, counted: DataFrame, keys: Sequence[str], weight: str, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Rows of `df` whose key occurs in `counted`; NULL keys match each other.

    `counted` has one row per key and its number of rows in `weight`.
    """
    on = [f"_on_{i}" for i in range(len(keys))]
    wanted = counted.select(
        *[column(k).alias(o) for k, o in zip(keys, on)], column(weight).alias("_weight")
    )
    heavy = wanted.where(F.col("_weight") > heavy_rows).select(*on)
    rows, fits = measure(heavy)
    if not rows or not fits:
        # None, or more than a broadcast may hold: adaptive execution splits skewed joins.
        return df.join(wanted.select(*on), _matches(keys), "left_semi")
    heavy_part = df.join(F.broadcast(heavy), _matches(keys), "left_semi")
    light_part = df.join(F.broadcast(heavy), _matches(keys), "left_anti").join(
        wanted.select(*on), _matches(keys), "left_semi"
    )
    return heavy_part.union(light_part)


def _named(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(k).isNotNull() for k in keys])


def key_weights(
    left: DataFrame, right: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Keys that both sides have and that are heavy on one, with the cells they need.

    `_left` and `_right` are the numbers of parts of each side. Both sides are
    counted before they meet, so nothing here grows with the rows of a key.
    """
    counts = [
        side.where(_named(keys)).groupBy(*[column(k) for k in keys])
        .agg(F.ceil(F.count(F.lit(1)) / heavy_rows).cast("long").alias(name))
        for side, name in ((left, "_left"), (right, "_right"))
    ]
    return counts[0].join(counts[1], list(keys)).where("_left > 1 or _right > 1")


def _cells(
    side: DataFrame, heavy: DataFrame, keys: Sequence[str], own: str, other: str, cell: tuple[str, str],
    copies: str, heavy_rows: int,
) -> DataFrame:
    """The rows of heavy keys, each in one part of its side and repeated for all parts of the other.

    Equal rows become one row with a number of copies, at most `heavy_rows`
    each. Where a row goes depends on its values alone, so a task that runs
    again sends it to the same cells.
    """
    columns = [column(c) for c in side.columns]
    rows = (
        side.join(F.broadcast(heavy), list(keys)).groupBy(*columns, own, other)
        .agg(F.count(F.lit(1)).alias("_all"))
    )
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_all") - 1) / heavy_rows))
    rows = rows.select("*", F.explode(parts).alias("_part"))
    number = F.xxhash64("_part", *hash_parts(side.columns))
    return rows.select(
        *columns,
        F.least(F.lit(heavy_rows), F.col("_all") - F.col("_part") * heavy_rows).alias(copies),
        F.pmod(number, F.col(own)).alias(cell[0]),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(cell[1]),
    )


def inner_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """All pairs of rows with equal keys; a NULL key matches nothing.

    The rows of a key that is heavy on either side form a grid: L rows in
    L / heavy_rows parts on the left meet R / heavy_rows parts on the right, so a
    cell holds about `heavy_rows` of either, however many the key has. All other
    keys go through an ordinary shuffle join. Both sides are read more than once:
    give scans or staged tables. Columns other than the keys must have different
    names and comparable types; -0.0 comes back as 0.0 from heavy rows.
    """
    keys = list(keys)
    clash = {c.lower() for c in left.columns if c not in keys} & {c.lower() for c in right.columns}
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    order = [column(c) for c in [*left.columns, *[c for c in right.columns if c not in keys]]]
    heavy = scratch.stage(key_weights(left, right, keys, heavy_rows), "heavy-keys")
    rows, fits = measure(heavy)
    if not rows or not fits:
        # None, or more than a broadcast may hold: adaptive execution splits skewed joins.
        return left.join(right, keys).select(order)
    light = [side.join(F.broadcast(heavy.select(*keys)), keys, "left_anti") for side in (left, right)]
    cells = _cells(left, heavy, keys, "_left", "_right", ("_i", "_j"), "_times", heavy_rows).join(
        _cells(right, heavy, keys, "_right", "_left", ("_j", "_i"), "_by", heavy_rows), [*keys, "_i", "_j"]
    )
    one = F.lit(1).cast("long")
    for copies in ("_times", "_by"):
        cells = cells.withColumn("_copy", F.explode(F.sequence(one, F.col(copies).cast("long"))))
    return light[0].join(light[1], keys).select(order).union(cells.select(order))


def pair_sums(
    left: DataFrame, right: DataFrame, keys: Sequence[str], pairs: str,
    left_sums: Mapping[str, str], right_sums: Mapping[str, str],
) -> DataFrame:
    """Per key the number of pairs of rows with equal keys, and sums over these pairs, without forming one.

    A row of one side is in as many pairs as the other side has rows of its key.
    So both sides are reduced to one row per key before they meet, and a key costs
    its L + R rows and not its L * R pairs. A NULL key matches nothing. `left_sums`
    and `right_sums` name the columns of each side to sum, by the name of the result.
    """
    keys = list(keys)
    sides = []
    for side, sums, rows in ((left, left_sums, "_left"), (right, right_sums, "_right")):
        totals = [F.sum(column(c)).alias(name) for name, c in sums.items()]
        grouped = side.where(_named(keys)).groupBy(*[column(k) for k in keys])
        sides.append(grouped.agg(F.count(F.lit(1)).alias(rows), *totals))
    times = [(n, "_right") for n in left_sums] + [(n, "_left") for n in right_sums]
    return sides[0].join(sides[1], keys).select(
        *[column(k) for k in keys], (F.col("_left") * F.col("_right")).alias(pairs),
        *[(column(n) * F.col(rows)).alias(n) for n, rows in times],
    )
