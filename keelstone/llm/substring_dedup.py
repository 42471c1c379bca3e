"""Substring deduplication by seed and extend.

A passage counts as repeated in a document if a window of `window` consecutive
words of it also starts in a document with a smaller id; its words are removed
there, so the first document keeps it.

Seeds: every window is anchored at the smallest hash among the k-word runs in
it (the leftmost, on ties), so equal windows have equal anchors and few anchors serve many
windows (winnowing). Documents meet on anchors only.

Extension: a seed carries the extent to which its windows reach to both sides
and a hash of all the words they span. Seeds of one anchor that agree on it are settled at once by
the smallest id among them, and as neighbouring seeds of a passage overlap,
this already extends most matches to their ends. Where occurrences of an anchor
disagree (at the ends of passages and at edits), the texts of those documents
are fetched and the seed is extended word by word: each of its windows is
compared by two hashes of its own words. Nothing is ever put out per pair of
occurrences, so a passage in thousands of documents costs a row for each. Anchors of
very common lines are found first and reduced before the shuffle.

Windows that are covered and overlap make maximal repeats; those of fewer than
`min_words` words are left alone.

Words are compared by 128 bits of hashes. Defined cases: NULL, empty and short texts hold no window and are left
as they are. Rows with equal ids are one document split over rows: they never
remove from each other, and each loses the words of its own text only; rows without an id
neither remove nor lose words. Extra columns are kept where a documents table is
returned. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StructType

from keelstone.llm.shared import fresh, repeated_ids, stage
from keelstone.llm.words import Words, map_blocks, mix, signed, text_bytes
from keelstone.operators.lookup import measure

WINDOW = 13
K = 5
REACH = WINDOW - K  # words a window may reach beyond its anchor on either side
HEAVY_SEEDS = 50_000  # seeds of one anchor that are too many for one task

SEED_SCHEMA = "anchor bigint, doc_id bigint, place bigint, span bigint"
ODD = np.uint64(0x9E3779B97F4A7C15)


def _run_hash(h: np.ndarray, at: np.ndarray, length: np.ndarray | int, salt: int = 0) -> np.ndarray:
    """Hash of the words at..at+length, for each of `at`."""
    g = np.full(len(at), mix(np.array([salt + 1], dtype=np.uint64))[0])
    length = np.broadcast_to(length, at.shape)
    for i in range(int(length.max()) if len(at) else 0):
        more = np.flatnonzero(length > i)
        g[more] = mix(g[more] * ODD + h[at[more] + i])
    return g


def _seeds(texts: pa.Array):
    """Seeds of one block: (text index, anchor, position, low, high, hash of all words spanned).

    The windows of a seed start `low`..`high` words before its position.
    """
    data, begin = text_bytes(texts)
    words = Words(data, begin)
    h = words.hashes()
    gram, first = words.grams(K, h)
    n_windows = np.maximum(words.counts - WINDOW + 1, 0)
    # Grams are numbered text by text; window i of a text spans its grams i..i+REACH.
    n_grams = np.maximum(words.counts - K + 1, 0)
    gram_start = np.cumsum(n_grams) - n_grams
    text = np.repeat(np.arange(len(n_windows)), n_windows)
    inner = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    window = gram_start[text] + inner
    if not len(window):
        none = np.zeros(0, np.int64)
        return none, none.astype(np.uint64), none, none, none, none.astype(np.uint64)
    view = np.lib.stride_tricks.sliding_window_view(gram, REACH + 1)
    offset = view[window].argmin(axis=1)
    anchor = window + offset
    # Consecutive windows with the same anchor make a seed.
    new = np.ones(len(anchor), dtype=bool)
    new[1:] = anchor[1:] != anchor[:-1]
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(anchor)])) - 1
    at = anchor[head]
    high, low = offset[head], offset[tail]
    word = first[at]
    span = _run_hash(h, word - high, high - low + WINDOW)
    owner = text[head]
    return owner, gram[at], word - words.first[owner], low, high, span


def _row(docs: DataFrame) -> str:
    """Column that tells rows apart: `row` where ids are repeated."""
    return "row" if "row" in docs.columns else "doc_id"


def seeds(docs: DataFrame) -> DataFrame:
    """One row per seed; `place` packs its position, low and high. A column `row` is carried."""
    carried = docs.columns[2:]

    def work(block):
        owner, anchor, at, low, high, span = _seeds(block.column(1))
        span = mix(span ^ mix((low * 16 + high).astype(np.uint64)))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(anchor)), block.column(0).take(pa.array(owner)),
                pa.array(at * 256 + low * 16 + high), pa.array(signed(span)),
                *(c.take(pa.array(owner)) for c in block.columns[2:]),
            ],
            ["anchor", "doc_id", "place", "span", *carried],
        )

    return map_blocks(docs, "text", work, SEED_SCHEMA + "".join(f", {c} bigint" for c in carried))


def _windows(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, key2, doc_id, start), and `row` if there is one, of all windows of the wanted seeds."""
    of, carried = _row(docs), docs.columns[2:]
    places = wanted.groupBy(F.col(of).alias("_id")).agg(F.collect_list("place").alias("places"))
    rows = docs.join(places, F.col(of) == F.col("_id")).select("doc_id", "text", "places", *carried)

    def work(block):
        data, begin = text_bytes(block.column(1))
        words = Words(data, begin)
        h = words.hashes()
        column = block.column(2)
        lengths = column.value_lengths().to_numpy(zero_copy_only=False)
        place = column.flatten().to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        at, low, high = place >> 8, (place >> 4) & 15, place & 15
        n = high - low + 1
        row = np.repeat(np.arange(len(place)), n)
        start = (at - high)[row] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        index = words.first[owner[row]] + start
        return pa.RecordBatch.from_arrays(
            [
                pa.array(signed(_run_hash(h, index, WINDOW, 1))),
                pa.array(signed(_run_hash(h, index, WINDOW, 2))),
                block.column(0).take(pa.array(owner[row])), pa.array(start),
                *(c.take(pa.array(owner[row])) for c in block.columns[3:]),
            ],
            ["key", "key2", "doc_id", "start", *carried],
        )

    schema = "key bigint, key2 bigint, doc_id bigint, start bigint"
    return map_blocks(rows, "text", work, schema + "".join(f", {c} bigint" for c in carried))


def _heavy_anchors(docs: DataFrame) -> DataFrame | None:
    """Anchors with too many seeds for one task, or None if there are none.

    Each block counts the anchors that it holds more than once, so a common line is counted
    almost in full while texts without repeats send nothing. The least count is raised until the
    list is measured to fit a broadcast.
    """

    def work(block):
        anchor = _seeds(block.column(1))[1]
        distinct, n = np.unique(anchor, return_counts=True)
        often = n > 1
        return pa.RecordBatch.from_arrays(
            [pa.array(signed(distinct[often])), pa.array(n[often].astype(np.int64))], ["anchor", "n"]
        )

    counted = stage(
        map_blocks(docs, "text", work, "anchor bigint, n bigint")
        .groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= HEAVY_SEEDS),
        "heavy_anchors",
    )
    least = HEAVY_SEEDS
    while True:
        heavy = counted.where(F.col("n") >= least).select("anchor")
        rows, fits = measure(heavy)
        if fits:
            return heavy if rows else None
        least *= 10


def _meeting(found: DataFrame) -> DataFrame:
    """Seeds whose anchor is in several documents, if they are settled or their anchor varies."""
    return found.where("min_doc < max_doc and (seed_doc < doc_id or varied)").select(
        _row(found), "place", (F.col("seed_doc") < F.col("doc_id")).alias("settled")
    )


def _met(docs: DataFrame) -> DataFrame:
    """(doc_id, place, settled) of the seeds that other documents have too."""
    heavy, found = _heavy_anchors(docs), seeds(docs)
    light = found if heavy is None else found.join(F.broadcast(heavy), "anchor", "left_anti")
    same_anchor = Window.partitionBy("anchor")
    met = _meeting(
        light.withColumn("seed_doc", F.min("doc_id").over(Window.partitionBy("anchor", "span")))
        .withColumn("min_doc", F.min("doc_id").over(same_anchor))
        .withColumn("max_doc", F.max("doc_id").over(same_anchor))
        .withColumn("varied", F.min("span").over(same_anchor) != F.max("span").over(same_anchor))
    )
    if heavy is None:
        return met
    # Seeds of heavy anchors are reduced before they are shuffled, and joined with what came
    # of it; adaptive execution splits that join.
    hot = stage(found.join(F.broadcast(heavy), "anchor", "left_semi"), "hot_seeds")
    spans = hot.groupBy("anchor", "span").agg(
        F.min("doc_id").alias("seed_doc"), F.max("doc_id").alias("last_doc")
    )
    anchors = spans.groupBy("anchor").agg(
        F.min("seed_doc").alias("min_doc"), F.max("last_doc").alias("max_doc"),
        (F.count(F.lit(1)) > 1).alias("varied"),
    )
    facts = spans.drop("last_doc").join(anchors, "anchor")
    return met.union(_meeting(hot.join(facts, ["anchor", "span"])))


def covered(docs: DataFrame) -> DataFrame:
    """(doc_id or `row`, ranges): word ranges of repeated windows, as start * 256 + length."""
    of = _row(docs)
    met = stage(_met(docs), "seeds")
    low = F.expr("shiftright(place, 4) & 15")
    high = F.expr("place & 15")
    settled = met.where("settled").select(
        of, (F.expr("shiftright(place, 8)") - high).alias("start"),
        (high - low + WINDOW).alias("length"),
    )
    first = F.min("doc_id").over(Window.partitionBy("key", "key2"))
    found = (
        _windows(docs, met.where("not settled")).withColumn("first_doc", first)
        .where("first_doc < doc_id").select(of, "start", F.lit(WINDOW).alias("length"))
    )
    return (
        settled.union(found)
        .groupBy(of)
        .agg(F.collect_list(F.col("start") * 256 + F.col("length")).alias("ranges"))
    )


def _removed(n_words: int, ranges: np.ndarray, min_words: int) -> np.ndarray:
    """Which words of a text lie in a repeat of at least `min_words` words."""
    depth = np.zeros(n_words + 1, dtype=np.int64)
    start, length = ranges >> 8, ranges & 255
    np.add.at(depth, start, 1)
    np.add.at(depth, start + length, -1)
    gone = np.cumsum(depth)[:n_words] > 0
    if min_words > WINDOW:
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a < min_words:
                gone[a:b] = False
    return gone


def _cut(texts: pa.Array, ranges: pa.Array, min_words: int):
    """Per text: number of words, of removed words, and the kept words (None: nothing removed)."""
    data, begin = text_bytes(texts)
    words = Words(data, begin)
    for i, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
        found = ranges[i]
        gone = None
        if found.is_valid and len(found.values):
            gone = _removed(b - a, found.values.to_numpy(zero_copy_only=False), min_words)
        kept = [
            data[s:e].tobytes()
            for s, e in zip(
                (words.start[a:b] if gone is None else words.start[a:b][~gone]).tolist(),
                (words.end[a:b] if gone is None else words.end[a:b][~gone]).tolist(),
            )
        ]
        n_gone = 0 if gone is None else int(gone.sum())
        yield b - a, n_gone, b" ".join(kept)


def _with_ranges(df: DataFrame) -> DataFrame:
    """`df` with the ranges of each row as a last column."""
    docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    of, ranges, names = fresh(df, "range_id"), fresh(df, "ranges"), df.columns
    mine = "doc_id"
    if repeated_ids(docs):
        # Rows that share an id get a number each, which stays the same once it is written.
        mine = fresh(df, "row_number")
        df = stage(df.withColumn(mine, F.monotonically_increasing_id()), "rows")
        docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.col(mine).alias("row"))
    found = covered(docs)
    found = found.select(F.col(_row(found)).alias(of), F.col("ranges").alias(ranges))
    found = df.join(found, df[mine] == found[of], "left").drop(of)
    return found if mine in names else found.drop(mine)


def digest(df: DataFrame, min_words: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row; kept words are joined by spaces."""

    def work(block):
        rows = list(_cut(block.column(1), block.column(2), min_words))
        return pa.RecordBatch.from_arrays(
            [
                block.column(0), pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )

    rows = _with_ranges(df.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"))
    return map_blocks(
        rows, "text", work, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    )


def remove_repeats(df: DataFrame, min_words: int = WINDOW) -> DataFrame:
    """`df` with the repeated passages taken out of `text`.

    A text without any is left as it is, white space included; in others the
    kept words are joined by single spaces. Rows that lose all words go.
    """
    rows = _with_ranges(df)
    flag = fresh(df, "all_gone")
    names = df.columns
    place = names.index("text")
    schema = StructType([*df.schema.fields]).add(flag, BooleanType())

    def work(block):
        texts = block.column(place)
        old = texts.to_pylist()
        new, gone = [], []
        for text, (n_words, n_gone, kept) in zip(old, _cut(texts, block.column(len(names)), min_words)):
            new.append(kept.decode("utf-8") if n_gone else text)
            gone.append(n_gone > 0 and n_gone == n_words)
        columns = list(block.columns[: len(names)])
        columns[place] = pa.array(new, pa.string())
        return pa.RecordBatch.from_arrays([*columns, pa.array(gone)], [*names, flag])

    return map_blocks(rows, "text", work, schema).where(~F.col(flag)).drop(flag)
