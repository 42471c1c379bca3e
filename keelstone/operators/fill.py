"""Forward and backward fill along an order.

The plain form is one window per key. A window sorts a whole key inside one
task, so a key too large for that is cut into chunks that follow the order:
values are filled inside each chunk, and the last value known before a chunk
is carried in from a table with one row per key and chunk. No task then holds
more than one chunk, whatever share of the rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from keelstone import scratch
from keelstone.functions.missing import column, known

# A key with at most this many rows is left to one task's external sort.
MAX_GROUP_ROWS = 5_000_000


def _ordered(partition: Sequence[str], order: Sequence[str], forward: bool) -> WindowSpec:
    columns = [column(c) for c in order]
    sort = [c.asc_nulls_first() if forward else c.desc_nulls_last() for c in columns]
    return Window.partitionBy(*[column(p) for p in partition]).orderBy(*sort)


def carry_last(
    df: DataFrame,
    value: str | Column,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    into: str,
    inclusive: bool = True,
    forward: bool = True,
) -> DataFrame:
    """Add `into`: the last non-NULL `value` at or before each row of its key.

    `chunk` must rise with `order` inside a key. `inclusive=False` looks only
    at rows strictly before, `forward=False` at the rows after instead.
    """
    value = column(value) if isinstance(value, str) else value
    df = df.withColumn("_value", value)
    end = 0 if inclusive else -1
    inside = _ordered([*keys, chunk], order, forward).rowsBetween(Window.unboundedPreceding, end)
    filled = df.withColumn("_near", F.last("_value", ignorenulls=True).over(inside))

    nearest = F.max_by if forward else F.min_by
    # A struct, as it is never NULL itself: a value at a NULL place counts, and such places come first.
    position = F.when(F.col("_value").isNotNull(), F.struct(*[column(c) for c in order]))
    before = _ordered(keys, [chunk], forward).rowsBetween(Window.unboundedPreceding, -1)
    group = [*keys, chunk]
    carried = (
        df.groupBy(*[column(g) for g in group])
        .agg(nearest("_value", position).alias("_edge"))
        .withColumn("_far", F.last("_edge", ignorenulls=True).over(before))
        .select(*[column(g).alias(f"_on_{i}") for i, g in enumerate(group)], "_far")
    )
    same = reduce(
        lambda a, b: a & b,
        [column(g).eqNullSafe(F.col(f"_on_{i}")) for i, g in enumerate(group)],
    )
    return filled.join(carried, same, "left").select(
        *[column(c) for c in df.columns if c not in ("_value", into)],
        F.coalesce("_near", "_far").alias(into),
    )


def fill(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    order: Sequence[str],
    forward: bool = True,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Replace missing `name` by the nearest known value before (after) it.

    `order` should be a total order inside a key; ties make the choice
    arbitrary. One counting pass over the key columns decides between the
    plain window and the chunked form, which give the same rows, and sets the
    number of chunks: range partitions are sampled, so they are planned at half of
    `max_group_rows`. With 0 there are as many chunks as shuffle partitions.
    """
    biggest, total = (
        df.groupBy(*[column(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.max("n"), F.sum("n")).first()
    )
    if (biggest or 0) <= max_group_rows:
        window = _ordered(keys, order, forward).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(name, F.last(known(df, name), ignorenulls=True).over(window))

    # Range partitions follow (keys, order) and are of even size however the
    # keys are spread. The partition number must be the same for every later
    # reader, hence the checkpoint.
    total_order = [column(c) for c in [*keys, *order]]
    if max_group_rows:
        chunks = -(-2 * (total or 0) // max_group_rows)
    else:
        chunks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A given number is kept: adaptive execution merges none of these partitions.
    ranged = scratch.checkpoint(
        df.repartitionByRange(max(chunks, 1), *total_order).withColumn("_chunk", F.spark_partition_id())
    )
    filled = carry_last(
        ranged, known(ranged, name), keys, "_chunk", order, into="_filled", forward=forward
    )
    return filled.select(
        *[F.col("_filled").alias(c) if c == name else column(c) for c in df.columns]
    )


def fill_forward(df: DataFrame, name: str, keys, order, **options) -> DataFrame:
    return fill(df, name, keys, order, forward=True, **options)


def fill_backward(df: DataFrame, name: str, keys, order, **options) -> DataFrame:
    return fill(df, name, keys, order, forward=False, **options)
