"""Sums of 64-bit keys over a whole table, gathered in packed arrays, and bit filters made of them.

A task adds up the keys of its blocks, holding at most about `KEPT` of them,
and deals the sums out to buckets by the keys' high bits. One row is what a
task has for one bucket: far fewer rows and bytes than a row per key. The
caller sets the number of buckets in proportion to the input, so that a bucket
stays small at any size; a common key is one entry per task. A tag can say where
a key occurs: the smallest of its tags is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from keelstone.llm.words import split_block

KEPT = 4_000_000
#: kind, keys, their weights (None: 1 each), their tags (None: no tags).
Part = tuple[int, np.ndarray, "np.ndarray | None", "np.ndarray | None"]
DEALT = "kind int, bucket int, keys binary, sums binary, tags binary"


class Sums(NamedTuple):
    """Distinct keys in order, the sum of the weights of each, and its smallest 32-bit tag."""

    keys: np.ndarray
    sums: np.ndarray
    tags: np.ndarray


def add_up(keys: np.ndarray, weights: np.ndarray | None = None, tags: np.ndarray | None = None) -> Sums:
    if weights is None and tags is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        weights = weights if weights is None else weights[order]
        tags = tags if tags is None else tags[order]
    if not len(keys):
        return Sums(keys, np.zeros(0, np.int64), np.zeros(0, np.uint32))
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sums = np.diff(np.append(at, len(keys))) if weights is None else np.add.reduceat(weights, at)
    least = np.zeros(len(at), np.uint32) if tags is None else np.minimum.reduceat(tags, at)
    return Sums(keys[at], sums.astype(np.int64), least.astype(np.uint32))


def _all_of(parts: Sequence[Sums]) -> Sums:
    return add_up(*(np.concatenate(x) for x in zip(*parts)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every key; it rises with the key."""
    return (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def deal(
    df: DataFrame, text: str, work: Callable[[pa.RecordBatch], Iterable[Part]], buckets: Sequence[int],
    narrow: Sequence[bool] = (),
) -> DataFrame:
    """A task's sums, in rows of DEALT.

    `work` gives the parts of a block; kind k goes to `buckets[k]` buckets. Of a
    narrow kind only the low 32 bits of the keys are passed on.
    """
    narrow = list(narrow) or [False] * len(buckets)

    def rows(kind: int, parts: list) -> Iterator[pa.RecordBatch]:
        keys, sums, tags = _all_of(parts)
        bucket = bucket_of(keys, buckets[kind])
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        keys = keys.astype("<u4") if narrow[kind] else keys
        # Some buckets at a time: a batch of a few megabytes.
        step = max(1, int(len(cuts) * 300_000 / max(len(keys), 1)))
        for i in range(0, len(cuts) - 1, step):
            own = list(zip(cuts[i : i + step], cuts[i + 1 : i + 1 + step]))
            yield pa.record_batch({
                "kind": pa.array([kind] * len(own), pa.int32()),
                "bucket": pa.array([int(bucket[a]) for a, _ in own], pa.int32()),
                "keys": pa.array([keys[a:b].tobytes() for a, b in own], pa.binary()),
                "sums": pa.array([sums[a:b].tobytes() for a, b in own], pa.binary()),
                "tags": pa.array([tags[a:b].tobytes() for a, b in own], pa.binary()),
            })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in buckets]
        size = 0
        for batch in batches:
            for block in split_block(batch, text):
                for kind, keys, weights, tags in work(block):
                    if len(keys):
                        held[kind].append(add_up(keys, weights, tags))
                        size += len(held[kind][-1].keys)
                if size >= KEPT:
                    for kind, parts in enumerate(held):
                        if parts:
                            yield from rows(kind, parts)
                            parts.clear()
                    size = 0
        for kind, parts in enumerate(held):
            if parts:
                yield from rows(kind, parts)

    return df.mapInArrow(run, DEALT)


def gather(
    dealt: DataFrame, finish: Callable[[int, int, Sums], pa.Table], schema: str, narrow: Sequence[bool] = (),
) -> DataFrame:
    """`finish(kind, bucket, sums)` of the total sums of every bucket."""
    narrow = dict(enumerate(narrow))

    def work(group: pa.Table) -> pa.Table:
        kind, bucket = group["kind"][0].as_py(), group["bucket"][0].as_py()
        kind_of_key = "<u4" if narrow.get(kind) else "<u8"
        types = {"keys": kind_of_key, "sums": "<i8", "tags": "<u4"}
        parts = [[np.frombuffer(x.as_buffer(), t) for x in group[name]] for name, t in types.items()]
        return finish(kind, bucket, _all_of([Sums(*part) for part in zip(*parts)]))

    return dealt.groupBy("kind", "bucket").applyInArrow(work, schema)


BITMAP_BITS = 1 << 26
_SEGMENT_BITS = 1 << 18


class Bitmap:
    """Whether a key may be in a set: never no for a key of the set.

    It takes 8 MiB whatever the size of the set; a larger set lets more other
    keys pass, so use it only to spare work before an exact test.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __getstate__(self) -> bytes:
        return self.bits.tobytes()

    def __setstate__(self, state: bytes) -> None:
        self.bits = np.frombuffer(state, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for shift in (0, 32):
            at = (keys >> np.uint64(shift)).astype(np.uint32) & np.uint32(BITMAP_BITS - 1)
            found &= (self.bits[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & 1 > 0
        return found


def bitmap(keys: DataFrame) -> Bitmap:
    """The bitmap of a table's column `key`, put together from segments."""
    key = F.col("key")
    low = key.bitwiseAND(BITMAP_BITS - 1)
    high = F.shiftrightunsigned(key, 32).bitwiseAND(BITMAP_BITS - 1)
    bits = keys.select(F.explode(F.array(low, high)).alias("bit"))
    bits = bits.select(
        F.floor(F.col("bit") / _SEGMENT_BITS).cast("int").alias("segment"),
        (F.col("bit") % _SEGMENT_BITS).cast("int").alias("bit"),
    ).distinct()

    def work(group: pa.Table) -> pa.Table:
        flags = np.zeros(_SEGMENT_BITS, dtype=np.uint8)
        flags[group["bit"].to_numpy()] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"segment": group["segment"][:1], "bits": pa.array([packed], pa.binary())})

    found = bits.groupBy("segment").applyInArrow(work, "segment int, bits binary").toArrow()
    whole = np.zeros(BITMAP_BITS // 8, dtype=np.uint8)
    size = _SEGMENT_BITS // 8
    for segment, packed in zip(found["segment"].to_pylist(), found["bits"].to_pylist()):
        whole[segment * size : (segment + 1) * size] = np.frombuffer(packed, np.uint8)
    return Bitmap(whole)
