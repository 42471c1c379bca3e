"""Benchmark decontamination: passages of documents within an edit distance of an item.

An item is contained in a document if some passage of it has an edit distance (in bytes
of lower-cased text with single spaces) of at most `rate * len(item)`.

1. Pieces: an item with k edits allowed is cut into k + 1 pieces of bytes, of which one at least
   is intact in every passage within k edits, wherever words begin or end. All places of all
   texts are looked up by the first bytes of the pieces.
2. Neighbours: of two parts of an item with i and j pieces and fewer than i + j edits together,
   one has fewer edits than pieces. So some intact piece lies in a pair of pieces with one edit at
   most, this in four pieces with at most three, and this in eight with at most seven. A
   place goes on only if all three hold: words of eight bytes are compared for
   the pair, and bit-parallel tables of many places at once are filled for four and eight.
3. Every place that is left is verified by the exact edit distance of the item
   to the best passage around it.

Steps 1 and 2 are necessary conditions, so no passage is lost, and step 3 never
accepts a wrong one. Items are looked up in blocks of bounded size, one pass over
the documents for each, so what is sent to the executors has a proven bound.

Defined cases: NULL and empty texts contain nothing; NULL and empty items match nothing. Without
`short_items`, items of one or two words that have no run of three words, of two words of five bytes
or more, and no word of eight or more, match nothing either. Repeated
rows, ids and items are judged row by row; of
several passages for one item in a row the closest counts, then the earliest. Extra
columns are ignored by `hits` and kept by `clean`. Empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, StructType

from keelstone.llm.shared import fresh
from keelstone.llm.words import Words, map_blocks, text_bytes

ODD = np.uint64(0x9E3779B97F4A7C15)

RATE = 0.15
LONG_WORD, LONGER_WORD = 5, 8  # bytes
PIECE = 8  # bytes of a piece that are looked up
BESIDE = 7  # bytes of the piece beside it that are compared
NODES = (4, 8)  # pieces that are compared together
NODE_BYTES = 64  # that fit a word of bits
FILTER_ROWS = 8192
ITEM_BLOCK_BYTES = 4 * 1024 * 1024
TEXT_BLOCK_BYTES = 2 * 1024 * 1024
PADDING = 256

HITS_SCHEMA = (
    "doc_id bigint, item_id bigint, distance bigint, item_bytes bigint, first_word bigint, "
    "last_word bigint"
)


@dataclass
class Index:
    """A block of items, ready for look-up. Pieces are sorted by length looked up and bytes."""

    ids: list[int]
    texts: list[bytes]
    sizes: np.ndarray
    allowed: np.ndarray  # edits of an item
    flat: np.ndarray  # all items
    begin: np.ndarray  # of an item in it
    runs: list[tuple[int, int, int]]  # length looked up, first and last piece of that length
    key: np.ndarray  # piece -> bytes looked up
    item: np.ndarray  # and its item
    place: np.ndarray  # and its byte offset in the item
    number: np.ndarray  # and how many pieces are before it
    right: np.ndarray  # whether the piece beside it follows
    beside: np.ndarray  # bytes of that, going away from the piece
    length: np.ndarray  # and how many


def normalised(texts: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words (lower case), and all texts with single spaces: bytes, word offsets, text offsets."""
    data, begin = text_bytes(texts)
    words = Words(data, begin, lower=True)
    length = words.end - words.start
    at = np.concatenate(([0], np.cumsum(length + 1)))
    out = np.full(int(at[-1]), 0x20, dtype=np.uint8)
    source = np.flatnonzero(words.inside)
    target = np.repeat(at[:-1] - (np.cumsum(length) - length), length) + np.arange(length.sum())
    out[target] = words.data[source]
    return words, out, at[:-1], at[words.first]


def _seed_words(words: Words) -> np.ndarray:
    """First words of runs of three, of two long ones, and longer ones."""
    at_three, at_two = words.grams(3)[1], words.grams(2)[1]
    length = words.end - words.start
    long = length >= LONG_WORD
    both = long[at_two] & long[at_two + 1] if len(at_two) else np.zeros(0, dtype=bool)
    return np.concatenate((at_three, at_two[both], np.flatnonzero(length >= LONGER_WORD)))


def _edited(text: bytes, edits: int, random: np.random.Generator) -> bytes:
    """A copy with random edits, for tests."""
    out = bytearray(text)
    for _ in range(edits):
        at, kind = int(random.integers(len(out))), int(random.integers(3))
        letter = int(random.integers(97, 123))
        if kind == 0:
            out[at] = letter
        elif kind == 1:
            out.insert(at, letter)
        elif len(out) > 1:
            del out[at]
    return bytes(out)


def _eight(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of `data`, the first in the low bits; `data` is padded after it."""
    return np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))


def _low(length: np.ndarray) -> np.ndarray:
    """Masks of the low `length` bytes, of eight at most."""
    bits = np.minimum(length, 8).astype(np.uint64) * np.uint64(8)
    full = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.maximum(bits, np.uint64(1)))
    return np.where(bits > 0, full, np.uint64(0))


def build_index(
    ids: list[int], texts: list[bytes], wanted: np.ndarray, rate: float = RATE
) -> Index:
    """Pieces of the wanted items of a block."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    allowed = np.array([int(rate * n) for n in sizes.tolist()], dtype=np.int64)
    begin = PADDING + np.cumsum(sizes) - sizes
    flat = np.concatenate(
        (np.zeros(PADDING, np.uint8), np.frombuffer(b"".join(texts), np.uint8), np.zeros(PADDING, np.uint8))
    )
    n = np.where(wanted & (sizes > 0), np.minimum(allowed + 1, np.maximum(sizes, 1)), 0)
    item = np.repeat(np.arange(len(texts)), n)
    number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    m, of = sizes[item], n[item]
    place, after = number * m // of, (number + 1) * m // of
    looked = np.minimum(m // of, PIECE)
    eight = _eight(flat)
    key = eight[begin[item] + place] & _low(looked)
    # The piece beside it in its pair: from the end of what is looked up, or before the piece.
    right = number % 2 == 0
    pair_end = np.minimum(number + 2 - number % 2, of) * m // of
    length = np.where(right, pair_end - place - looked, place - (number - 1) * m // of)
    length = np.minimum(length, BESIDE)
    at = begin[item] + place
    beside = np.where(right, eight[at + looked], eight[at - 8].byteswap()) & _low(length)
    order = np.lexsort((key, looked))
    looked = looked[order]
    cuts = np.flatnonzero(np.diff(looked)) + 1
    runs = [
        (int(looked[a]), int(a), int(b))
        for a, b in zip([0, *cuts], [*cuts, len(looked)]) if a < b
    ]
    return Index(
        ids, texts, sizes, allowed, flat, begin, runs, key[order], item[order], place[order],
        number[order], right[order], beside[order], length[order],
    )


def item_blocks(
    items: DataFrame, id_col: str = "item_id", text_col: str = "text",
    limit: int = ITEM_BLOCK_BYTES, rate: float = RATE, short_items: bool = True,
) -> Iterator[Index]:
    """Indexes of blocks of items, of at most `limit` bytes or one item each."""
    rows = items.select(F.col(id_col).cast("bigint"), F.col(text_col)).where(F.col(text_col).isNotNull())
    ids, texts, size = [], [], 0
    for number, text in rows.toLocalIterator():
        if ids and size + len(text.encode()) > limit:
            yield _index_of(ids, texts, rate, short_items)
            ids, texts, size = [], [], 0
        ids.append(number)
        texts.append(text)
        size += len(text.encode())
    if ids:
        yield _index_of(ids, texts, rate, short_items)


def _index_of(ids, texts, rate, short_items) -> Index:
    words, flat, _, text_at = normalised(pa.array(texts, pa.large_string()))
    wanted = np.full(len(texts), short_items)
    if not short_items:
        wanted[words.text_of()[_seed_words(words)]] = True
    plain = [flat[a : max(b - 1, a)].tobytes() for a, b in zip(text_at[:-1], text_at[1:])]
    return build_index(ids, plain, wanted, rate)


def distance(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of `pattern` to a passage of `text`, and where the passage ends.

    Bit-parallel dynamic programming over one column of the table at a time.
    """
    m = len(pattern)
    if not m:
        return 0, 0
    seen: dict[int, int] = {}
    for i, c in enumerate(pattern):
        seen[c] = seen.get(c, 0) | (1 << i)
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = seen.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        hp = minus | (full & ~(xh | plus))
        hm = plus & xh
        if hp & top:
            score += 1
        elif hm & top:
            score -= 1
        hp = (hp << 1) & full
        hm = (hm << 1) & full
        plus = hm | (full & ~(xv | hp))
        minus = hp & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def _looked_up(eight: np.ndarray, limit: int, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(place, piece) of all places before `limit` whose bytes start a piece."""
    places, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length, a, b in index.runs:
        keys = index.key[a:b]
        # A small table of hashes rules out most places at once.
        bits = np.uint64(64 - min(max(int(b - a).bit_length() + 5, 16), 24))
        table = np.zeros(1 << (64 - int(bits)), dtype=bool)
        table[(keys * ODD) >> bits] = True
        value = eight[PADDING:limit] & _low(np.array(length))
        maybe = np.flatnonzero(table[(value * ODD) >> bits])
        value = value[maybe]
        lo = np.searchsorted(keys, value, "left")
        n = np.searchsorted(keys, value, "right") - lo
        places.append(np.repeat(maybe, n) + PADDING)
        pieces.append(a + np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
    return np.concatenate(places), np.concatenate(pieces)


def _beside_agrees(eight: np.ndarray, at: np.ndarray, piece: np.ndarray, looked: np.ndarray, index: Index) -> np.ndarray:
    """Whether the piece beside is there with one edit at most."""
    right = index.right[piece]
    ours = np.where(right, eight[at + looked], eight[at - 8].byteswap())
    theirs, n = index.beside[piece], index.length[piece]
    x = (ours ^ theirs) & _low(n)
    # First byte that differs; what follows it agrees on the same place or one further on either side.
    same = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64) // 8
    shift = np.minimum(same, 7).astype(np.uint64) * np.uint64(8)
    o, t, rest = ours >> shift, theirs >> shift, np.maximum(n - same, 0)
    byte, less = np.uint64(8), _low(np.maximum(rest - 1, 0))
    changed = ((o ^ t) >> byte) & less
    added = ((o >> byte) ^ t) & _low(rest)
    left_out = (o ^ (t >> byte)) & less
    return (x == 0) | (changed == 0) | (added == 0) | (left_out == 0)


def _node_agrees(flat: np.ndarray, at: np.ndarray, piece: np.ndarray, pieces: int, index: Index) -> np.ndarray:
    """Whether the `pieces` pieces that hold this one are there with fewer edits than pieces."""
    item, number = index.item[piece], index.number[piece]
    of, m = np.minimum(index.allowed[item] + 1, index.sizes[item]), index.sizes[item]
    first = number - number % pieces
    last = np.minimum(first + pieces, of)
    begin, end = first * m // of, last * m // of
    edits = last - first - 1
    # One table of bytes for every node that occurs.
    node, which = np.unique(index.begin[item] + begin, return_index=True)
    row = np.searchsorted(node, index.begin[item] + begin)
    size = (end - begin)[which]
    equal = np.zeros((len(node), 256), dtype=np.uint64)
    for i in range(int(min(size.max(initial=0), NODE_BYTES))):
        has = np.flatnonzero(size > i)
        equal[has, index.flat[node[has] + i]] |= np.uint64(1 << i)
    size, one = end - begin, np.uint64(1)
    out = size > NODE_BYTES
    start = at - (index.place[piece] - begin) - edits
    steps = size + 2 * edits
    plus = np.full(len(at), 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    minus = np.zeros(len(at), dtype=np.uint64)
    top = np.minimum(size - 1, 63).astype(np.uint64)
    score = size.copy()
    edge = len(flat) - 1
    for step in range(int(steps[~out].max(initial=0))):
        where = start + step
        eq = equal[row, flat[np.minimum(np.maximum(where, 0), edge)]]
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        hp = minus | ~(xh | plus)
        hm = plus & xh
        score += ((hp >> top) & one).astype(np.int64) - ((hm >> top) & one).astype(np.int64)
        hp, hm = hp << one, hm << one
        plus = hm | ~(xv | hp)
        minus = hp & xv
        out |= (score <= edits) & (step < steps)
    return out


def _places(flat: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray]:
    """(place in `flat`, piece) of all places that may be in a passage close to the piece's item."""
    padded = np.concatenate((np.zeros(PADDING, np.uint8), flat, np.zeros(PADDING, np.uint8)))
    eight = _eight(padded)
    at, piece = _looked_up(eight, PADDING + len(flat), index)
    looked = np.zeros(len(index.key), dtype=np.int64)
    for length, a, b in index.runs:
        looked[a:b] = length
    good = _beside_agrees(eight, at, piece, looked[piece], index)
    at, piece = at[good], piece[good]
    for pieces in NODES:
        good = [
            _node_agrees(padded, at[a : a + FILTER_ROWS], piece[a : a + FILTER_ROWS], pieces, index)
            for a in range(0, len(at), FILTER_ROWS)
        ]
        if good:
            good = np.concatenate(good)
            at, piece = at[good], piece[good]
    return at - PADDING, piece


def _regions(at: np.ndarray, piece: np.ndarray, text_at: np.ndarray, index: Index):
    """(text, item, begin, end) of the passages to verify; near ones of one item are joined."""
    item = index.item[piece]
    owner = np.searchsorted(text_at, at, "right") - 1
    start = at - index.place[piece]
    inside = at < text_at[owner + 1] - 1
    owner, item, start = np.unique(np.stack((owner, item, start))[:, inside], axis=1)
    allowed, size = index.allowed[item], index.sizes[item]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (item[1:] != item[:-1])
    whole = (allowed == 0) & (size <= PIECE)
    # The first place of a short item that has to be there as it is, is the result.
    taken = new | ~whole
    new[1:] |= start[1:] - start[:-1] > size[1:]
    owner, item, start, new = owner[taken], item[taken], start[taken], new[taken]
    head = np.flatnonzero(new)
    tail = np.concatenate((head[1:], [len(new)])) - 1 if len(head) else head
    owner, item = owner[head], item[head]
    allowed, size = index.allowed[item], index.sizes[item]
    begin = np.maximum(start[head] - allowed, text_at[owner])
    end = np.minimum(start[tail] + size + allowed, text_at[owner + 1] - 1)
    return zip(owner.tolist(), item.tolist(), begin.tolist(), end.tolist())


def search(texts: pa.Array, index: Index) -> list[tuple[int, int, int, int, int]]:
    """(text, item, distance, first word, last word) of the closest passage for each found pair."""
    words, flat, word_at, text_at = normalised(texts)
    at, piece = _places(flat, index)
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for owner, item, a, b in _regions(at, piece, text_at, index):
        key = (owner, item)
        if key in best and best[key][0] == 0:
            continue
        pattern = index.texts[item]
        region = flat[a:b].tobytes()
        found, end = distance(pattern, region)
        if found > index.allowed[item]:
            continue
        _, back = distance(pattern[::-1], region[:end][::-1])
        place = (found, a + end - back, a + end)
        if key not in best or place < best[key]:
            best[key] = place
    out = []
    for (t, i), (found, a, b) in sorted(best.items()):
        first_word = int(np.searchsorted(word_at, a, "right")) - 1 - int(words.first[t])
        last_word = int(np.searchsorted(word_at, b, "left")) - 1 - int(words.first[t])
        out.append((t, i, found, first_word, last_word))
    return out


def hits(docs: DataFrame, items: DataFrame, rate: float = RATE, short_items: bool = True) -> DataFrame:
    """One row per document and item it contains, see `HITS_SCHEMA`."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text"))
    out = None
    for index in item_blocks(items, rate=rate, short_items=short_items):
        found = map_blocks(rows, "text", _hits_work(index), HITS_SCHEMA, TEXT_BLOCK_BYTES)
        out = found if out is None else out.union(found)
    return docs.sparkSession.createDataFrame([], HITS_SCHEMA) if out is None else out


def _hits_work(index: Index):
    def work(block):
        found = search(block.column(1), index)
        ids = block.column(0).to_pylist()
        columns = [
            [ids[f[0]] for f in found], [index.ids[f[1]] for f in found], [f[2] for f in found],
            [len(index.texts[f[1]]) for f in found], [f[3] for f in found], [f[4] for f in found],
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], [c.split()[0] for c in HITS_SCHEMA.split(", ")]
        )

    return work


def clean(docs: DataFrame, items: DataFrame, rate: float = RATE, short_items: bool = True) -> DataFrame:
    """`docs` without the rows that contain an item."""
    names = docs.columns
    place = names.index("text")
    flag = fresh(docs, "leaks")
    schema = StructType([*docs.schema.fields]).add(flag, BooleanType())
    for index in item_blocks(items, rate=rate, short_items=short_items):

        def work(block, index=index):
            leaks = np.zeros(len(block), dtype=bool)
            for found in search(block.column(place), index):
                leaks[found[0]] = True
            return pa.RecordBatch.from_arrays([*block.columns, pa.array(leaks)], [*names, flag])

        searched = map_blocks(docs, "text", work, schema, TEXT_BLOCK_BYTES)
        docs = searched.where(~F.col(flag)).drop(flag)
    return docs
