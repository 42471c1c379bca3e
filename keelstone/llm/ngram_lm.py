"""Language-model scores from a log-frequency Bloom filter.

The counts of all n-grams of the training rows are quantised to levels on a
logarithmic scale; an n-gram of level j is put into the filter j times, once
with each of the levels 1 to j. The level of an n-gram is read back by probing
for level 1, 2, ... until a probe fails; a false positive can raise a count by
a step and never lowers one. The filter is made of blocks of `BLOCK_BITS` and
an n-gram lives in one block, so it is built from the shuffled counts block by
block. Its size follows the text: `BITS_PER_BYTE` bits for every byte trained on,
so the rate of false positives does not change with the input.

A filter of up to `BROADCAST_BYTES` is broadcast and probed where the texts are.
A larger one stays a table: texts are dealt out in blocks of `TEXT_BYTES`, the distinct
n-grams of a block go to their buckets as packed marks, and the levels found there, a
byte each in the same order, meet the block's texts again. The scores are the same
either way.

Probabilities are smoothed by the next lower order as a prior of weight `PRIOR`:
P(w | u) = (min(c(uw), c(u)) + PRIOR * P(w)) / (c(u) + PRIOR), with add-one
estimates for single tokens. Texts begin with a mark that is no token and end
with one that is.

The base score takes exact counts: the `COMMON` most frequent tokens are
broadcast (a fixed number of rows), all others are joined. Tokens are told apart by 64-bit
hashes.

Defined cases: a NULL or empty text is the end mark alone. Rows are scored one
by one, equal ones alike. Without training rows every count is 0. An empty
table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from keelstone.llm.counting import bucket_of, deal, gather
from keelstone.llm.shared import stage
from keelstone.llm.words import BLOCK_BYTES, Words, lists, mix, signed, split_block, text_bytes
from keelstone.scratch import drop

ORDER = 2
PRIOR = 500.0
LEVEL_BASE = 1.5
BLOCK_BITS = 1 << 16
BUCKET_BLOCKS = 64
BUCKET_BITS = BLOCK_BITS * BUCKET_BLOCKS
PROBES = 4
BITS_PER_BYTE = 0.6
BROADCAST_BYTES = 128 * 1024 * 1024
COMMON = 262_144
# Text bytes of a block that looks its n-grams up together.
TEXT_BYTES = 8 * 1024 * 1024
# Text bytes for each bucket of exact counts.
BUCKET_BYTES = 4 * 1024 * 1024

_BEGIN, _END = np.uint64(0x0B), np.uint64(0x0E)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _levels() -> np.ndarray:
    """The least count of every level."""
    steps = [math.ceil(LEVEL_BASE**j - 1e-9) for j in range(110)]
    return np.array(sorted({s for s in steps if s < 1 << 62}), dtype=np.int64)


LEAST = _levels()
# What a level stands for: the middle of its counts. No level is 0.
COUNT_OF = np.concatenate(([0.0], (LEAST[:-1] + LEAST[1:] - 1) / 2, [float(LEAST[-1])]))


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEAST, counts, side="right")


def _places(marks: np.ndarray, level: int) -> list[np.ndarray]:
    """Bits of n-grams in their bucket, for one level."""
    block = (marks >> np.uint32(26)).astype(np.int64) * BLOCK_BITS
    bits = mix(marks.astype(np.uint64) * _ODD + np.uint64(level))
    return [block + ((bits >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(PROBES)]


def bucket_bits(marks: np.ndarray, counts: np.ndarray) -> bytes:
    """The filter's part for one bucket, from 32-bit marks and their counts."""
    flags = np.zeros(BUCKET_BITS, dtype=np.uint8)
    levels = level_of(counts)
    for level in range(1, int(levels.max(initial=0)) + 1):
        marks, levels = marks[levels >= level], levels[levels >= level]
        for place in _places(marks, level):
            flags[place] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def probe(bits: np.ndarray, base: np.ndarray | int, marks: np.ndarray) -> np.ndarray:
    """Levels of n-grams; `base` is the first bit of their buckets."""
    found = np.zeros(len(marks), dtype=np.int64)
    base = np.broadcast_to(np.asarray(base, dtype=np.int64), marks.shape)
    active = np.arange(len(marks))
    for level in range(1, len(LEAST) + 1):
        if not len(active):
            break
        inside = np.ones(len(active), dtype=bool)
        for place in _places(marks[active], level):
            at = base[active] + place
            inside &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        active = active[inside]
        found[active] = level
    return found


class Tokens:
    """Tokens of a block of texts: a begin mark, the words and an end mark each."""

    def __init__(self, texts: pa.Array):
        words = Words(*text_bytes(texts), lower=True)
        rows = len(texts)
        n, row = len(words), words.text_of()
        self.begin = words.first[:-1] + 2 * np.arange(rows)
        self.end = words.first[1:] + 2 * np.arange(rows) + 1
        self.rows = rows
        self.ids = np.empty(n + 2 * rows, dtype=np.uint64)
        self.ids[np.arange(n) + 2 * row + 1] = words.hashes()
        self.ids[self.begin], self.ids[self.end] = _BEGIN, _END
        self.row = np.repeat(np.arange(rows), self.end - self.begin + 1)
        self.place = np.arange(len(self.ids)) - self.begin[self.row]
        # All but the begin marks.
        self.counted = self.place > 0

    def grams(self, order: int) -> list[np.ndarray]:
        """Keys of the n-grams that end at every place, for n from 1 to `order` (0 where there is none)."""
        out = [mix(self.ids + _ODD)]
        for n in range(2, order + 1):
            chain = np.zeros_like(self.ids)
            chain[1:] = mix(out[-1][:-1] * _ODD + self.ids[1:])
            chain[self.place < n - 1] = 0
            out.append(chain)
        return out


class Model(NamedTuple):
    """Counts of the training rows; `counts` and `filters` are tables."""

    order: int
    buckets: int
    tokens: int
    distinct: int
    common: tuple[np.ndarray, np.ndarray]
    counts: DataFrame
    filters: DataFrame


def _number(x) -> int:
    return int(x or 0)


def learn(docs: DataFrame, training: Column, order: int = ORDER) -> Model:
    """The model of the rows of `docs` for which `training` is true."""
    texts = docs.where(training).select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = _number(texts.agg(F.sum(F.octet_length("text") + 2)).first()[0])
    buckets = 1 + int(size * BITS_PER_BYTE) // BUCKET_BITS
    exact = 1 + size // BUCKET_BYTES

    def count(block: pa.RecordBatch):
        own = Tokens(block.column("text"))
        yield 0, own.ids[own.counted], None, None
        for n, keys in enumerate(own.grams(order)):
            yield 1, keys if n == 0 else keys[own.place >= n], None, None

    def finish(kind, bucket, found):
        keys, sums, _ = found
        packed = (bucket_bits(keys, sums), None) if kind else (keys.tobytes(), sums.tobytes())
        return pa.table({
            "kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()),
            "keys": pa.array(packed[:1], pa.binary()), "sums": pa.array(packed[1:], pa.binary()),
            "distinct": pa.array([len(keys)], pa.int64()), "total": pa.array([int(sums.sum())], pa.int64()),
        })

    narrow = [False, True]
    dealt = deal(texts, "text", count, [exact, buckets], narrow)
    learned = stage(
        gather(dealt, finish, "kind int, bucket int, keys binary, sums binary, distinct long, total long", narrow),
        "ngrams",
    )
    single = learned.where("kind = 0")
    total, distinct = single.agg(F.sum("total"), F.sum("distinct")).first()
    top = _unpacked(single, COMMON).orderBy(F.desc("count"), "key").limit(COMMON).toArrow()
    keys = top["key"].to_numpy().view(np.uint64)
    sort = np.argsort(keys)
    common = keys[sort], top["count"].to_numpy()[sort]
    filters = learned.where("kind = 1").select("bucket", F.col("keys").alias("bits"))
    return Model(order, buckets, _number(total), _number(distinct), common, _unpacked(single), filters)


def _unpacked(packed: DataFrame, best: int | None = None) -> DataFrame:
    """(key, count) of packed counts; only the `best` most frequent of each bucket, if given."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, sums in zip(batch.column("keys"), batch.column("sums")):
                keys, sums = np.frombuffer(keys.as_buffer(), "<i8"), np.frombuffer(sums.as_buffer(), "<i8")
                if best is not None and len(keys) > best:
                    first = np.lexsort((keys, -sums))[:best]
                    keys, sums = keys[first], sums[first]
                for at in range(0, len(keys), 65536):
                    yield pa.record_batch({
                        "key": pa.array(keys[at : at + 65536]), "count": pa.array(sums[at : at + 65536])
                    })

    return packed.select("keys", "sums").mapInArrow(run, "key long, count long")


def filter_of(model: Model) -> np.ndarray:
    """All bits of a model's filter, in order of the buckets."""
    size = BUCKET_BITS // 8
    whole = np.zeros(model.buckets * size, dtype=np.uint8)
    found = model.filters.toArrow()
    for bucket, bits in zip(found["bucket"].to_pylist(), found["bits"]):
        whole[bucket * size : (bucket + 1) * size] = np.frombuffer(bits.as_buffer(), np.uint8)
    return whole


def _mark(keys: np.ndarray) -> np.ndarray:
    return (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _log_p(own: Tokens, order: int, total: int, distinct: int, levels: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Log10 probability of every text; `levels` looks n-grams up."""
    counts = []
    for keys in own.grams(order):
        known, back = np.unique(keys, return_inverse=True)
        counts.append(COUNT_OF[levels(known)][back])
    p = (counts[0] + 1.0) / (total + distinct + 1.0)
    for n in range(2, order + 1):
        context = np.zeros_like(p)
        context[1:] = counts[n - 2][:-1]
        seen = np.minimum(counts[n - 1], context)
        p = np.where(own.place >= n - 1, (seen + PRIOR * p) / (context + PRIOR), p)
    logs = np.where(own.counted, np.log10(np.minimum(p, 1.0)), 0.0)
    return np.bincount(own.row, logs, own.rows)


SCORED = (
    "row long, doc_id long, n_tokens long, n_known long, base double, score double, "
    "rest array<long>, rest_times array<int>"
)


def _scorer(order: int, total: int, distinct: int, common) -> Callable:
    """Score a block of (row, doc_id, text, ...); `levels` looks n-grams up."""

    def work(block: pa.RecordBatch, levels: Callable[[np.ndarray], np.ndarray]) -> pa.RecordBatch:
        own = Tokens(block.column("text"))
        keys, times = common.value
        ids, row = own.ids[own.counted], own.row[own.counted]
        at = np.minimum(np.searchsorted(keys, ids), max(len(keys) - 1, 0))
        found = keys[at] == ids if len(keys) else np.zeros(len(ids), dtype=bool)
        logs = np.zeros(len(ids))
        logs[found] = np.log10(times[at[found]] + 1.0)
        rest, rest_row = ids[~found], row[~found]
        order_of = np.lexsort((rest, rest_row))
        rest, rest_row = rest[order_of], rest_row[order_of]
        new = np.ones(len(rest), dtype=bool)
        new[1:] = (rest[1:] != rest[:-1]) | (rest_row[1:] != rest_row[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(rest))).astype(np.int32)
        lengths = np.bincount(rest_row[first], minlength=own.rows)
        return pa.record_batch({
            "row": block.column("row"), "doc_id": block.column("doc_id"),
            "n_tokens": pa.array(np.bincount(row, minlength=own.rows).astype(np.int64)),
            "n_known": pa.array(np.bincount(row[found], minlength=own.rows).astype(np.int64)),
            "base": pa.array(np.bincount(row, logs, own.rows)),
            "score": pa.array(_log_p(own, order, total, distinct, levels)),
            "rest": lists(pa.array(signed(rest[first])), lengths),
            "rest_times": lists(pa.array(counts), lengths),
        })

    return work


def _scored_by_broadcast(texts: DataFrame, model: Model, work: Callable) -> DataFrame:
    bits, buckets = texts.sparkSession.sparkContext.broadcast(filter_of(model)), model.buckets

    def levels(keys: np.ndarray) -> np.ndarray:
        return probe(bits.value, bucket_of(keys, buckets) * BUCKET_BITS, _mark(keys))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in split_block(batch, "text"):
                yield work(block, levels)

    return texts.mapInArrow(run, SCORED)


def _blocks(texts: DataFrame) -> DataFrame:
    """(block, row, doc_id, text) of (row, doc_id, text): runs of rows of about `TEXT_BYTES` of text."""
    limit = TEXT_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = None, 0
        for batch in batches:
            for part in split_block(batch, "text", min(limit, BLOCK_BYTES)):
                if block is None or size >= limit:
                    # The number of a block is that of its first row.
                    block, size = part.column("row")[0].as_py(), 0
                size += len(text_bytes(part.column("text"))[0])
                yield pa.record_batch(
                    [pa.array(np.full(len(part), block)), *(part.column(n) for n in ("row", "doc_id", "text"))],
                    ["block", "row", "doc_id", "text"],
                )

    return texts.mapInArrow(run, "block long, row long, doc_id long, text string")


def _known(batches: Iterable[pa.RecordBatch], order: int) -> np.ndarray:
    """Distinct n-grams of texts, in order."""
    blocks = (block for batch in batches for block in split_block(batch, "text"))
    return np.unique(np.concatenate([
        np.unique(np.concatenate(Tokens(block.column("text")).grams(order))) for block in blocks
    ]))


def _asked(blocks: DataFrame, model: Model) -> DataFrame:
    """(block, piece, bucket, marks): marks of the distinct n-grams of a piece, in order of the n-grams.

    A piece is what a task reads of a block in one go, rows with consecutive
    numbers; its name is the first of them. Texts thus stay where they are.
    """
    order, buckets = model.order, model.buckets

    def packed(block: int, piece: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        keys = _known(parts, order)
        bucket, marks = bucket_of(keys, buckets), _mark(keys).astype("<u4")
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        return pa.record_batch({
            "block": pa.array(np.full(len(cuts) - 1, block)), "piece": pa.array(np.full(len(cuts) - 1, piece)),
            "bucket": pa.array(bucket[cuts[:-1]].astype(np.int32)),
            "marks": pa.array([marks[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, block, piece, after = [], None, None, None
        for batch in batches:
            if not len(batch):
                continue
            of, row = batch.column("block").to_numpy(), batch.column("row").to_numpy()
            cuts = 1 + np.flatnonzero((of[1:] != of[:-1]) | (row[1:] != row[:-1] + 1))
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
                if of[a] != block or row[a] != after:
                    if parts:
                        yield packed(block, piece, parts)
                    parts, block, piece = [], of[a], row[a]
                parts.append(batch.slice(a, b - a))
                after = row[b - 1] + 1
        if parts:
            yield packed(block, piece, parts)

    return blocks.select("block", "row", "text").mapInArrow(run, "block long, piece long, bucket int, marks binary")


def _answered(asked: DataFrame, model: Model) -> DataFrame:
    """(block, piece, bucket, levels): what the filter's table has for every mark, a byte each."""

    def work(filters: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        for marks in rows["marks"]:
            marks = np.frombuffer(marks.as_buffer(), "<u4")
            # A bucket without a row has no n-grams of the training rows.
            none = not len(filters)
            found = np.zeros(len(marks)) if none else probe(
                np.frombuffer(filters["bits"][0].as_buffer(), np.uint8), 0, marks
            )
            out.append(found.astype(np.uint8).tobytes())
        return rows.select(["block", "piece", "bucket"]).append_column("levels", pa.array(out, pa.binary()))

    pairs = model.filters.groupBy("bucket").cogroup(asked.groupBy("bucket"))
    return pairs.applyInArrow(work, "block long, piece long, bucket int, levels binary")


def _scored_by_join(texts: DataFrame, model: Model, work: Callable) -> DataFrame:
    order = model.order
    blocks = stage(_blocks(texts), "blocks", compression="zstd")
    answered = stage(_answered(_asked(blocks, model), model), "levels")

    def pieces(group: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        group, answers = group.sort_by("row"), answers.sort_by([("piece", "ascending"), ("bucket", "ascending")])
        first, at = np.unique(answers["piece"].to_numpy(), return_index=True)
        cuts = [*np.searchsorted(group["row"].to_numpy(), first).tolist(), len(group)]
        at = [*at.tolist(), len(answers)]
        for i in range(len(first)):
            batches = group.slice(cuts[i], cuts[i + 1] - cuts[i]).to_batches()
            found = b"".join(answers["levels"].slice(at[i], at[i + 1] - at[i]).to_pylist())
            keys, found = _known(batches, order), np.frombuffer(found, np.uint8)
            for batch in batches:
                for block in split_block(batch, "text"):
                    yield work(block, lambda wanted: found[np.searchsorted(keys, wanted)])

    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        return pa.Table.from_batches(pieces(group, answers))

    pairs = blocks.groupBy("block").cogroup(answered.groupBy("block"))
    scored = stage(pairs.applyInArrow(run, SCORED), "scores")
    drop(blocks, answered)
    return scored


def score(docs: DataFrame, model: Model, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    work = _scorer(model.order, model.tokens, model.distinct, context.broadcast(model.common))
    if model.buckets * BUCKET_BITS // 8 <= broadcast_bytes:
        scored = stage(_scored_by_broadcast(texts, model, work), "scores")
    else:
        scored = _scored_by_join(texts, model, work)
    # Tokens that are not among the common ones get their exact counts by a join.
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("of")).select(
        "row", F.col("of.rest").alias("key"), F.col("of.rest_times").alias("times")
    )
    rest = rest.join(model.counts, "key").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("count") + 1.0)).alias("rest_base"),
        F.sum("times").alias("rest_known"),
    )
    every = math.log10(model.tokens + model.distinct + 1)
    base = F.col("base") + F.coalesce("rest_base", F.lit(0.0)) - F.col("n_tokens") * every
    return scored.drop("rest", "rest_times").join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), F.round(base, 9).alias("base_score"), "score",
    )
