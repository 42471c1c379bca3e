"""Collocations by prefix-free parsing.

Texts are cut at punctuation into pieces, and pieces into chunks wherever the
hash of `LONGEST - 1` words is 0 modulo `TRIGGER`: the cut depends on the words
alone, so equal passages give equal chunks wherever they stand. A chunk ends
with the words that trigger the cut and the next one begins with them. The
distinct chunks of a language are a dictionary, with the number of times that
each occurs in the parse. Phrases are counted inside the distinct chunks,
weighted by that number. A phrase is counted where it starts, and what starts
in the last `LONGEST - 1` words of a chunk belongs to the next one, so the
overlap counts once.

A phrase can only reach the least count if its parts do. Words are counted
first, then phrases of two frequent words, then longer ones of frequent pairs.
The frequent ones are looked up in a bitmap of fixed size, which may let a rare
one pass but loses none; counts are exact (for 64-bit hashes of the words).

Scores are exact: products are decimals of 38 digits, divided in whole numbers.

Defined cases: a NULL or empty text has no words; a NULL language is `und`,
the same as the language `und`. Equal rows count each. Ties go to the smaller
phrase in byte order. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from keelstone.llm.counting import Bitmap, bitmap, deal, gather
from keelstone.llm.shared import stage
from keelstone.llm.words import Words, map_blocks, mix, signed, split_block, text_bytes

LONGEST = 5
OVERLAP = LONGEST - 1
TRIGGER = 32
# Words of the dictionary for each bucket of counts.
BUCKET_WORDS = 400_000

# How often the parts of a cut meet against chance, in thousandths; exact up to 38 digits.
SCORE = (
    "(cast(1000 as decimal(4,0)) * cast(a as decimal(17,0)) * cast(n as decimal(17,0)))"
    " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
)

IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[0x20, 0x09]] = True
IS_CUT = np.zeros(256, dtype=bool)
IS_CUT[list(b".,;:!?\n\x0b\x0c\r")] = True

CHUNKS = "lang string, last boolean, starts int, chunk string"


def _joined(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words with a space after each, and where each word starts there."""
    length = words.end - words.start + 1
    at = np.concatenate(([0], np.cumsum(length)))
    index = np.arange(at[-1]) + np.repeat(words.start - at[:-1], length)
    out = np.append(words.data, np.uint8(0x20))[index]
    out[at[1:] - 1] = 0x20
    return out, at


def _chunks(block: pa.RecordBatch) -> pa.RecordBatch:
    data, at = text_bytes(block.column("text"))
    words = Words(data, at, lower=True, space=IS_BLANK | IS_CUT)
    n, row = len(words), words.text_of()
    cuts = np.cumsum(IS_CUT[words.data])[words.start] if n else np.zeros(0, np.int64)
    new = np.ones(n, dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (cuts[1:] != cuts[:-1])
    pieces = np.append(np.flatnonzero(new), n)
    rest = np.repeat(pieces[1:], np.diff(pieces)) - np.arange(n)
    window, first = words.grams(OVERLAP)
    trigger = np.zeros(n, dtype=bool)
    trigger[first] = window % np.uint64(TRIGGER) == 0
    start = np.flatnonzero(new | trigger & (rest >= OVERLAP))
    stop = np.append(start[1:], n)[: len(start)]
    last = np.append(new, True)[stop] if n else np.zeros(0, dtype=bool)
    joined, place = _joined(words)
    begin, end = place[start], place[np.where(last, stop, stop + OVERLAP)] - 1
    size = end - begin if len(start) else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.cumsum(size)))
    index = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
    text = pa.LargeStringArray.from_buffers(
        len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined[index].tobytes())
    )
    return pa.record_batch({
        "lang": block.column("lang").cast(pa.string()).take(pa.array(row[start])),
        "last": pa.array(last),
        "starts": pa.array((stop - start).astype(np.int32)),
        "chunk": text.cast(pa.string()),
    })


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary: distinct chunks (lang, last, starts, chunk) and their `copies`.

    `starts` is the number of words that belong to the chunk and not to the next.
    """
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").alias("text")
    ).where("text is not null")
    chunks = map_blocks(texts, "text", _chunks, CHUNKS)
    return chunks.groupBy("lang", "last", "starts", "chunk").agg(F.count(F.lit(1)).alias("copies"))


class _Block:
    """Keys of the words of a block of the dictionary."""

    def __init__(self, block: pa.RecordBatch):
        self.words = Words(*text_bytes(block.column("chunk")))
        row = self.words.text_of()
        self.keys = word_keys(self.words, block.column("lang"), row)
        self.copies = block.column("copies").to_numpy()[row]
        place = np.arange(len(row)) - self.words.first[:-1][row]
        self.counted = place < block.column("starts").to_numpy()[row]
        # A chunk's tag depends on its words; a phrase is spelled by the chunk with its smallest tag.
        marks = mix(self.keys + place.astype(np.uint64))
        tags = np.add.reduceat(marks, self.words.first[:-1]) if len(marks) else marks
        self.tags = (tags >> np.uint64(32)).astype(np.uint32)[row]

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return self.words.grams(n, self.keys)


def word_keys(words: Words, langs: pa.Array, row: np.ndarray) -> np.ndarray:
    """Hashes of words that differ between languages."""
    codes = langs.dictionary_encode()
    seeds = np.array(
        [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in codes.dictionary.to_pylist()],
        dtype=np.uint64,
    )
    return mix(words.hashes() ^ seeds[codes.indices.to_numpy()][row]) if len(row) else words.hashes()


def _words_of(block: pa.RecordBatch):
    own = _Block(block)
    keys, at = own.grams(1)
    at = at[own.counted[at]]
    return [(0, keys[own.counted], own.copies[at], None)]


def _pairs_of(frequent):
    def work(block: pa.RecordBatch):
        own = _Block(block)
        words, _ = own.grams(1)
        common = frequent.value.has(words)
        keys, at = own.grams(2)
        pick = own.counted[at] & common[at] & common[np.minimum(at + 1, len(common) - 1)]
        return [(0, keys[pick], own.copies[at[pick]], own.tags[at[pick]])]

    return work


def _longer_of(frequent, longest: int):
    def work(block: pa.RecordBatch):
        own = _Block(block)
        pairs, at = own.grams(2)
        common = np.zeros(len(own.words) + longest, dtype=bool)
        common[at] = frequent.value.has(pairs)
        out, chain = [], common
        for n in range(3, longest + 1):
            # Every pair of the phrase is frequent.
            chain = chain[:-1] & common[n - 2 :]
            keys, at = own.grams(n)
            pick = own.counted[at] & chain[at]
            out.append((n - 3, keys[pick], own.copies[at[pick]], own.tags[at[pick]]))
        return out

    return work


def _counted(dictionary: DataFrame, work, buckets: int, kinds: int, least: int, first: int, label: str) -> DataFrame:
    """Keys with a count of `least` or more: (words, key, count, spelled)."""

    def finish(kind, bucket, found):
        keys, sums, tags = (x[found.sums >= least] for x in found)
        return pa.table({
            "words": pa.array(np.full(len(keys), kind + first, np.int32)),
            "key": pa.array(signed(keys)), "count": pa.array(sums),
            "spelled": pa.array(signed(_spelled_by(keys, tags))),
        })

    dealt = deal(dictionary, "chunk", work, [buckets] * kinds)
    return stage(gather(dealt, finish, "words int, key long, count long, spelled long"), label)


def _spelled_by(keys: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """One mark for a phrase and the tag of a chunk that holds it."""
    return mix(keys ^ mix(tags.astype(np.uint64)))


def _phrases(dictionary: DataFrame, frequent, longest: int) -> DataFrame:
    """(key, lang, phrase) of the phrases that `frequent` may have, each from few chunks."""

    def spell(block: pa.RecordBatch, told: set) -> pa.RecordBatch:
        own = _Block(block)
        joined, place = _joined(own.words)
        text = joined.tobytes()
        row = own.words.text_of()
        langs = block.column("lang").to_pylist()
        out = {"key": [], "lang": [], "phrase": []}
        for n in range(2, longest + 1):
            keys, at = own.grams(n)
            pick = np.flatnonzero(frequent.value.has(_spelled_by(keys, own.tags[at])))
            _, first = np.unique(keys[pick], return_index=True)
            for i in pick[first].tolist():
                key = int(keys[i])
                if key not in told:
                    told.add(key)
                    out["key"].append(key)
                    out["lang"].append(langs[row[at[i]]])
                    out["phrase"].append(text[place[at[i]] : place[at[i] + n] - 1].decode())
        return pa.record_batch({
            "key": pa.array(signed(np.array(out["key"], dtype=np.uint64))),
            "lang": pa.array(out["lang"], pa.string()), "phrase": pa.array(out["phrase"], pa.string()),
        })

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set = set()
        for batch in batches:
            for block in split_block(batch, "chunk"):
                # A phrase told twice does no harm: the set is only held small.
                if len(told) > 1_000_000:
                    told.clear()
                yield spell(block, told)

    found = dictionary.mapInArrow(run, "key long, lang string, phrase string")
    return found.groupBy("key").agg(F.min(F.struct("lang", "phrase")).alias("of")).select("key", "of.*")


def _cuts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The two parts of every cut of a phrase."""
    for batch in batches:
        words = Words(*text_bytes(batch.column("phrase")))
        own = word_keys(words, batch.column("lang"), words.text_of())
        size, first = words.counts, words.first[:-1]
        key_of = []
        for n in range(1, LONGEST):
            keys, at = words.grams(n, own)
            here = np.zeros(len(words) + 1, dtype=np.uint64)
            here[at] = keys
            key_of.append(here)
        out = {"key": [], "a": [], "k": [], "size": [], "left": [], "right": []}
        for k in range(1, LONGEST):
            for n in range(k + 1, LONGEST + 1):
                pick = np.flatnonzero(size == n)
                for name, values in (
                    ("key", batch.column("key").to_numpy()[pick]), ("a", batch.column("a").to_numpy()[pick]),
                    ("k", np.full(len(pick), k)), ("size", np.full(len(pick), n)),
                    ("left", signed(key_of[k - 1][first[pick]])),
                    ("right", signed(key_of[n - k - 1][first[pick] + k])),
                ):
                    out[name].append(values)
        yield pa.record_batch({n: pa.array(np.concatenate(v).astype(np.int64)) for n, v in out.items()})


def mine(
    docs: DataFrame, least: int = 100, per_lang: int = 2000, cover_percent: int = 100
) -> DataFrame:
    """The first `per_lang` collocations of every language, of 2 to LONGEST words.

    Phrases found `least` times or more are scored by their worst cut; those
    that lie inside a longer one with `cover_percent` of their count are left
    out. Returns lang, rank, phrase, a, l, r, n, score.
    """
    spark = docs.sparkSession
    dictionary = stage(parse(docs), "chunks")
    per = dictionary.groupBy("lang").agg(F.sum(F.col("copies") * F.col("starts")).alias("n"))
    words = dictionary.agg(F.sum("starts")).first()[0] or 0
    buckets = 8 + words // BUCKET_WORDS

    def shared(keys: DataFrame):
        return spark.sparkContext.broadcast(bitmap(keys))

    ones = _counted(dictionary, _words_of, buckets, 1, least, 1, "words")
    twos = _counted(dictionary, _pairs_of(shared(ones)), buckets, 1, least, 2, "pairs")
    more = _counted(
        dictionary, _longer_of(shared(twos), LONGEST), buckets, LONGEST - 2, least, 3, "phrases"
    )
    frequent = twos.union(more)
    counts = ones.union(frequent).select("key", "count")
    spelled = _phrases(dictionary, shared(frequent.select(F.col("spelled").alias("key"))), LONGEST)
    phrases = stage(
        spelled.join(frequent.select("key", F.col("count").alias("a")), "key"), "candidates"
    )
    cuts = stage(
        phrases.mapInArrow(_cuts, "key long, a long, k long, size long, left long, right long"), "cuts"
    )
    # A longer phrase covers its first and its last words; longer ones still count no more.
    covers = cuts.where("k = size - 1").select(F.col("left").alias("key"), "a").union(
        cuts.where("k = 1").select("right", "a")
    ).groupBy("key").agg(F.max("a").alias("longer"))
    kept = phrases.join(covers, "key", "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < cover_percent * F.col("a"))
    ).select("key", "lang", "phrase", "a")
    parts = (
        cuts.select("key", "k", "left", "right")
        .join(counts.select(F.col("key").alias("left"), F.col("count").alias("l")), "left")
        .join(counts.select(F.col("key").alias("right"), F.col("count").alias("r")), "right")
    )
    scored = (
        kept.join(per, "lang").join(parts, "key").withColumn("score", F.expr(SCORE))
        .groupBy("key", "lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("key", "lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of each part of a language first, so that no task ranks a whole one.
    part = F.pmod(F.col("key"), F.lit(64))
    nearly = scored.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    ).where(F.col("rank") <= per_lang)
    ranked = nearly.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= per_lang).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
