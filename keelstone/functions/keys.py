"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from keelstone import scratch
from keelstone.functions.missing import column


def running_id() -> Column:
    """Unique 64-bit id: partition number and row position. No shuffle.

    The values follow the physical layout, so give them to a frame once, right
    before it is written, and never compare them between runs.
    """
    return F.monotonically_increasing_id()


def hashed_id(*names: str) -> Column:
    """64-bit id that depends on the business key only and so never changes.

    `xxhash64` skips NULLs, so each value is hashed with its NULL flag. Two
    keys may share a hash (likely from some 10^9 keys on): check it with
    `check_unique` where uniqueness matters, or use `running_id`.
    """
    return F.xxhash64(*hash_parts(names))


def hash_parts(names: Iterable[str]) -> list[Column]:
    """What to hash of a row: each value and its NULL flag, as the hash skips NULLs."""
    return [part for name in names for part in (column(name), column(name).isNull())]


def fingerprint(names: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row, in columns _fp_0 and _fp_1."""
    return [
        F.xxhash64(F.lit(seed), *hash_parts(names)).alias(f"_fp_{i}")
        for i, seed in enumerate((0x5EED, 0xFACADE))
    ]


def with_dense_id(df: DataFrame, keys: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """Add ids 0 to n - 1 in the order of `keys`, then of all other columns.

    The rows are dealt out by ranges of that order and sorted; a row's id is its
    place plus the rows of all partitions before its own. So the ids have no gaps
    and depend on the rows alone: neither a rerun nor another number of
    partitions changes them. A key with many rows spreads over partitions by its
    other columns; only the sizes of the partitions are brought together.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name}")
    order = [column(c) for c in [*keys, *[c for c in df.columns if c not in keys]]]
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(count, *order).sortWithinPartitions(*order)
    # Partition number above 33 bits of the place in it.
    staged = scratch.stage(placed.withColumn("_at", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright("_at", 33)
    sizes = staged.groupBy(part.alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_of")) - F.col("_size")
    starts = sizes.select("_of", before.alias("_before"))
    place = F.col("_at").bitwiseAND((1 << 33) - 1)
    return staged.join(F.broadcast(starts), part == F.col("_of")).select(
        *[column(c) for c in df.columns], (F.col("_before") + place).alias(name)
    )
