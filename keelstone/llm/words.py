"""Words, shingles and their hashes for whole Arrow blocks of texts.

A word is a run of bytes other than ASCII white space. Everything here works on
the bytes of many texts at once and in blocks of bounded size, so a task's
memory does not grow with its partition; only a single text larger than a
block makes a block of its own size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Small enough for a core's cache.
BLOCK_BYTES = 512 * 1024

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_ODD_1 = np.uint64(0x9E3779B97F4A7C15)
_ODD_2 = np.uint64(0xBF58476D1CE4E5B9)
_ODD_3 = np.uint64(0x94D049BB133111EB)
# Words longer than this are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing of unsigned integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD_2
    x ^= x >> np.uint64(27)
    x *= _ODD_3
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Words:
    """Words of the texts of one block.

    start, end: byte range of every word in `data`; first[i]:first[i + 1] are
    the words of text i; text_start: byte offsets of the texts. `space` marks
    the bytes that part words.
    """

    def __init__(
        self, data: np.ndarray, text_start: np.ndarray, lower: bool = False, space: np.ndarray = IS_SPACE
    ):
        self.data = LOWER[data] if lower else data
        self.text_start = text_start
        inside = ~space[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        cut = text_start[:-1]
        cut = cut[cut < len(data)]
        before[cut] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        last = text_start[1:] - 1
        after[last[(last >= 0) & (text_start[1:] > text_start[:-1])]] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.inside = inside
        self.first = np.searchsorted(self.start, text_start)
        self.first[-1] = len(self.start)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Number of set byte flags in every text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.text_start[1:]] - total[self.text_start[:-1]]

    def hashes(self) -> np.ndarray:
        """64-bit hash of every word's bytes."""
        length = self.end - self.start
        padded = np.concatenate((self.data, np.zeros(8, np.uint8)))
        eight = np.ndarray(len(self.data) + 1, dtype="<u8", buffer=padded, strides=(1,))
        h = mix(length.astype(np.uint64) * _ODD_1)
        active = np.flatnonzero(length > 0)
        for offset in range(0, _LONG, 8):
            if offset:
                active = active[length[active] > offset]
            if not len(active):
                break
            rest = length[active] - offset
            chunk = eight[self.start[active] + offset]
            short = np.minimum(rest, 8).astype(np.uint64)
            # Keep the low bytes that belong to the word.
            chunk = chunk & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - short * np.uint64(8)))
            h[active] = mix((h[active] ^ chunk) * _ODD_1)
        for i in np.flatnonzero(length > _LONG):
            word = self.data[self.start[i] : self.end[i]].tobytes()
            h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def grams(self, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every run of `k` words inside one text, and the index of its first word."""
        h = self.hashes() if hashes is None else hashes
        ends = np.repeat(self.first[1:], self.counts)
        at = np.flatnonzero(np.arange(len(h)) + k <= ends)
        g = h[at].copy()
        for i in range(1, k):
            g = mix(g * _ODD_1 + h[at + i])
        return mix(g + np.uint64(k)), at


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each starts (NULL is empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    size = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, size)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def split_block(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` of at most `limit` bytes of text, but one text at least."""
    column = batch.column(batch.schema.get_field_index(text))
    _, at = text_bytes(column)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield batch.slice(row, stop - row)
        row = stop


def map_blocks(
    df: DataFrame,
    text: str,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]],
    schema: str,
    limit: int = BLOCK_BYTES,
) -> DataFrame:
    """Apply `work` to bounded blocks of `df`."""

    def run(batches):
        for batch in batches:
            for block in split_block(batch, text, limit):
                yield from _as_batches(work(block))

    return df.mapInArrow(run, schema)


def _as_batches(result):
    return [result] if isinstance(result, pa.RecordBatch) else result


def lists(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    """List array of consecutive runs of `values`."""
    at = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values)


def distinct_per_text(lengths: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of consecutive runs: (values, run lengths). Sorts in place."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b - a > 1:
            values[a:b].sort()
    new = np.ones(len(values), dtype=bool)
    new[1:] = values[1:] != values[:-1]
    new[starts[lengths > 0]] = True
    kept = np.concatenate(([0], np.cumsum(new)))
    return values[new], kept[ends] - kept[starts]
