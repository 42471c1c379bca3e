"""N-gram Jaccard self join of documents: a size-aware join of light and heavy sets.

A document's set holds the hashes of its distinct `k`-word shingles (all words
as one if there are fewer than `k`). Documents link when
`100 * |A n B| >= percent * |A u B|`; the join is exact for these hashes.

Sets that are equal are grouped first, so any number of copies costs one set.
For the rest, a pair (a <= b, by size) may differ in at most
`(100 - percent) * (a + b) / (100 + percent)` elements:

* light sets: all subsets that leave out up to t elements are enumerated, and
  two linked sets have such a subset in common;
* heavy sets: the hash range is cut into one cell more than the elements a pair
  may differ in, so linked sets agree on a whole cell. Cells are the keys of
  inverted lists, which are scanned.

The boundary between both is chosen by cost: rows to be shuffled for either
form, plus the pairs that cells of small sets bring together by chance, from
the counted sizes of the sets.

A scan compares only pairs that can still matter. First every set is verified
against the first member of its lists and its neighbour in them (pairs grow with the rows),
and components are built; then lists that still hold several components are
scanned in full, but a pair is put out only if it lies in two components and
its bitmaps (whose Hamming distance is at most the number of elements that
differ) do not rule it out. Copies by the thousand thus never become pairs.
Such a bitmap is full for sets of thousands of elements, so pairs of large sets are then
compared by bitmaps that grow with the sets. Hashes are only shuffled for the pairs left.

Defined cases: NULL, empty or blank texts have an empty set and link with
nothing. Equal rows stay rows of the result. Rows of one id are in one component, and each of
them is compared by its own text; a row without an id
belongs to no component. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keelstone.llm.components import components
from keelstone.llm.shared import fresh, repeated_ids, stage
from keelstone.llm.words import (
    Words, distinct_per_text, lists, map_blocks, mix, signed, text_bytes,
)
from keelstone.operators.lookup import fits_broadcast
from keelstone.scratch import drop

BITMAP_WORDS = 16  # 1,024 bits
LARGE_SET = 1365  # elements of which 1,024 bits are too few
CLASS_RATIO = 1.25
LIGHT_CHOICES = (0, 1, 2)  # elements left out of light subsets
ROW_COST = 1.0  # a shuffled row, the unit of cost
PAIR_COST = 0.05  # a compared pair


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text: (hashes, set sizes)."""
    data, at = text_bytes(texts)
    words = Words(data, at, lower=True)
    h = words.hashes()
    gram, first = words.grams(k, h)
    counts = words.counts
    # A text of fewer than k words is one shingle of all of them.
    n_grams = np.maximum(counts - k + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        single = np.array(
            [_chain(h[words.first[i] : words.first[i + 1]]) for i in short], dtype=np.uint64
        )
        place = np.concatenate(([0], np.cumsum(n_grams)))[short]
        gram = np.insert(gram, place, single)
        n_grams[short] = 1
    return distinct_per_text(n_grams, gram)


def _chain(h: np.ndarray) -> int:
    g = h[:1].copy()
    for x in h[1:]:
        g = mix(g * np.uint64(0x9E3779B97F4A7C15) + x)
    return int(mix(g + np.uint64(len(h)))[0])


def _spare(size: int, cells: int) -> int:
    """Empty cells a set may leave out of the lists.

    Two empty cells agree by chance. With two further cells for each one left
    out on either side, linked sets still agree on a listed cell. As many are
    left out as few sets of this size have.
    """
    if cells == 1:
        return 0
    extra = 1
    for _ in range(8):
        mean = (cells + 2 * extra) * math.exp(-size / (cells + 2 * extra))
        wanted = max(1, math.ceil(mean + 2 * math.sqrt(mean)))
        if wanted <= extra or cells + 2 * wanted > size:
            break
        extra = wanted
    return extra


class Sizes:
    """Size classes: class j joins smaller sets of low[j]..high[j] with sets up to reach[j]."""

    def __init__(self, percent: int, light: int, largest: int):
        self.percent, self.light = percent, light
        odds = (100 - percent, percent)
        # Smaller sets up to here differ in at most `light` elements from their partners.
        self.boundary = ((light + 1) * odds[1] - 1) // odds[0] if light and odds[0] else 0
        ratio = max(CLASS_RATIO, 100 / percent)
        low, high, cells, spare = [], [], [], []
        at = self.boundary + 1
        while at <= largest:
            top = max(at, int(at * ratio))
            need = top * odds[0] // odds[1] + 1
            extra = _spare(at, need)
            low.append(at)
            high.append(top)
            cells.append(need + 2 * extra)
            spare.append(extra)
            at = top + 1
        self.low, self.high = np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)
        self.reach = self.high * 100 // percent
        self.cells, self.spare = np.array(cells, dtype=np.int64), np.array(spare, dtype=np.int64)
        self.light_reach = self.boundary * 100 // percent

    def classes_of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, class) of every set and class it takes part in."""
        rows, classes = [], []
        own = np.searchsorted(self.high, sizes)
        for back in range(0, 3):
            j = own - back
            ok = (j >= 0) & (j < len(self.low)) & (sizes > 0)
            ok[ok] &= (self.low[j[ok]] <= sizes[ok]) & (sizes[ok] <= self.reach[j[ok]])
            rows.append(np.flatnonzero(ok))
            classes.append(j[ok])
        r, c = np.concatenate(rows), np.concatenate(classes)
        order = np.argsort(r, kind="stable")
        return r[order], c[order]


def light_keys(values: np.ndarray, leave_out: int) -> np.ndarray:
    """Keys of the subsets of one set that lack up to `leave_out` elements."""
    with np.errstate(over="ignore"):
        total = values.sum(dtype=np.uint64)
        sums = [np.array([total], dtype=np.uint64)]
        for r in range(1, min(leave_out, len(values) - 1) + 1):
            sums.append(total - _sums(values, r))
    sizes = np.concatenate([np.full(len(s), len(values) - i) for i, s in enumerate(sums)])
    return mix(np.concatenate(sums) ^ mix(sizes.astype(np.uint64)))


def _sums(values: np.ndarray, r: int) -> np.ndarray:
    if r == 1:
        return values
    at = np.array(list(combinations(range(len(values)), r)))
    return values[at].sum(axis=1, dtype=np.uint64)


def cell_keys(
    values: np.ndarray, sizes: np.ndarray, classes: Sizes
) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number of keys of each set): one key per set, class and cell."""
    rows, cls = classes.classes_of(sizes)
    if not len(rows):
        return np.zeros(0, np.uint64), np.zeros(len(sizes), np.int64)
    start = np.concatenate(([0], np.cumsum(sizes)))
    n = sizes[rows]
    owner = np.repeat(np.arange(len(rows)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    v = values[np.repeat(start[rows], n) + inner]
    cells = classes.cells[cls]
    base = np.cumsum(cells) - cells
    # Values are sorted and uniform, so a cell is a range of them.
    cell = ((v >> np.uint64(32)) * cells[owner].astype(np.uint64)) >> np.uint64(32)
    place = base[owner] + cell.astype(np.int64)
    edge = np.searchsorted(place, np.arange(cells.sum() + 1))
    with np.errstate(over="ignore"):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(v), dtype=np.uint64)))
        sums = total[edge[1:]] - total[edge[:-1]]
    which = np.arange(cells.sum()) - np.repeat(base, cells)
    salt = mix((np.repeat(cls, cells).astype(np.uint64) << np.uint64(32)) | which.astype(np.uint64))
    inside = np.diff(edge)
    keys = mix(mix(sums ^ salt) + inside.astype(np.uint64))
    empty = np.concatenate(([0], np.cumsum(inside == 0)))
    nth_empty = empty[1:] - np.repeat(empty[base], cells)
    listed = (inside > 0) | (nth_empty > np.repeat(classes.spare[cls], cells))
    per_set = np.bincount(np.repeat(rows, cells)[listed], minlength=len(sizes)).astype(np.int64)
    return keys[listed], per_set


def bitmaps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Parity bitmaps; two differ in at most as many bits as their sets in elements."""
    bits = np.zeros((len(sizes), BITMAP_WORDS * 64), dtype=np.uint8)
    place = (mix(values) >> np.uint64(64 - 10)).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    flat = np.bincount(row * bits.shape[1] + place, minlength=bits.size) & 1
    return np.packbits(flat.astype(np.uint8).reshape(bits.shape), axis=1).view(np.int64)


def large_bitmap(values: np.ndarray) -> bytes:
    """Parity bitmap of one set: a power of two of bits, at least 3 for 4 elements."""
    size = 1 << (3 * len(values) // 4).bit_length()
    flags = np.bincount((mix(values) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(flags.astype(np.uint8)).tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two large bitmaps differ; the longer one is folded to the shorter."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(y) > len(x):
        half = len(y) // 2
        y = y[:half] ^ y[half:]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, f1, f2): set size and fingerprint of every document."""

    def work(block):
        values, sizes = shingle_sets(block.column(1), k)
        f1, f2 = _fingerprints(values, sizes)
        return pa.RecordBatch.from_arrays(
            [block.column(0), pa.array(sizes.astype(np.int64)), pa.array(f1), pa.array(f2)],
            ["doc_id", "n", "f1", "f2"],
        )

    return map_blocks(docs, "text", work, "doc_id bigint, n bigint, f1 bigint, f2 bigint")


def _fingerprints(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.concatenate(([0], np.cumsum(sizes)))
    out = []
    with np.errstate(over="ignore"):
        for salt in (1, 2):
            total = np.cumsum(mix(values + np.uint64(salt)), dtype=np.uint64)
            total = np.concatenate((np.zeros(1, np.uint64), total))
            out.append(signed(mix(total[ends[1:]] - total[ends[:-1]])))
    return out[0], out[1]


def choose_light(histogram: list[tuple[int, int]], percent: int) -> int:
    """Elements left out of light subsets (0: no light sets), by estimated cost.

    histogram: (set size, number of distinct sets).
    """
    if percent >= 100:
        return 0
    sizes = np.array([h[0] for h in histogram], dtype=np.float64)
    counts = np.array([h[1] for h in histogram], dtype=np.float64)

    def cost(leave_out: int) -> float:
        classes = Sizes(percent, leave_out, 1)
        light = sizes <= classes.light_reach
        heavy = sizes > classes.boundary
        subsets = np.ones_like(sizes)
        for r in range(1, leave_out + 1):
            term = np.ones_like(sizes)
            for i in range(r):
                term = term * (sizes - i) / (i + 1)
            subsets += np.maximum(term, 0)
        cells = sizes * (100 - percent) / percent + 1
        rows = (counts * subsets)[light].sum() + (counts * cells)[heavy].sum()
        # A cell that is empty in both sets brings any two sets of a class together.
        n_heavy = counts[heavy]
        chance = cells[heavy] * np.exp(-2 * sizes[heavy] / cells[heavy])
        pairs = (n_heavy * (CLASS_RATIO - 1) * sizes[heavy] * n_heavy * chance).sum() / 2
        return ROW_COST * rows + PAIR_COST * pairs

    return min(LIGHT_CHOICES, key=cost)


def _keys(docs: DataFrame, k: int, classes: Sizes) -> DataFrame:
    """(id, keys) of every document given."""

    def work(block):
        values, sizes = shingle_sets(block.column(1), k)
        heavy, per_set = cell_keys(values, sizes, classes)
        start = np.concatenate(([0], np.cumsum(sizes)))
        heavy_start = np.concatenate(([0], np.cumsum(per_set)))
        lengths = per_set.copy()
        pieces = []
        light = (sizes > 0) & (sizes <= classes.light_reach)
        if classes.light and light.any():
            for i in range(len(sizes)):
                pieces.append(heavy[heavy_start[i] : heavy_start[i + 1]])
                if light[i]:
                    pieces.append(light_keys(values[start[i] : start[i + 1]], classes.light))
                    lengths[i] += len(pieces[-1])
            heavy = np.concatenate(pieces) if pieces else heavy
        return pa.RecordBatch.from_arrays(
            [block.column(0), lists(pa.array(signed(heavy)), lengths)], ["id", "keys"]
        )

    return map_blocks(docs, "text", work, "id bigint, keys array<bigint>")


def _members(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, bits, large) of the documents given; `large` is NULL for sets that `bits` suffice for."""

    def work(block):
        values, sizes = shingle_sets(block.column(1), k)
        bits = bitmaps(values, sizes)
        ends = np.cumsum(sizes)
        large = [large_bitmap(values[e - n : e]) if n > LARGE_SET else None for n, e in zip(sizes, ends)]
        return pa.RecordBatch.from_arrays(
            [
                block.column(0), pa.array(sizes.astype(np.int64)),
                lists(pa.array(bits.reshape(-1)), np.full(len(sizes), BITMAP_WORDS)),
                pa.array(large, pa.binary()),
            ],
            ["id", "n", "bits", "large"],
        )

    return map_blocks(docs, "text", work, "id bigint, n bigint, bits array<bigint>, large binary")


def _hashes(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, hashes) of the documents given."""

    def work(block):
        values, sizes = shingle_sets(block.column(1), k)
        return pa.RecordBatch.from_arrays(
            [block.column(0), pa.array(sizes.astype(np.int64)), lists(pa.array(signed(values)), sizes)],
            ["id", "n", "hashes"],
        )

    return map_blocks(docs, "text", work, "id bigint, n bigint, hashes array<bigint>")


def _may_link(percent: int) -> Column:
    """Sizes and bitmaps of (na, ba), (nb, bb) allow a link."""
    differ = sum(
        (F.bit_count(F.col("ba")[i].bitwiseXOR(F.col("bb")[i])) for i in range(BITMAP_WORDS)),
        F.lit(0),
    )
    return (
        (F.lit(percent) * F.greatest("na", "nb") <= F.lit(100) * F.least("na", "nb"))
        & ((100 + percent) * differ <= (100 - percent) * (F.col("na") + F.col("nb")))
    )


def _side(rows: DataFrame, x: str, *columns: str) -> DataFrame:
    return rows.select(F.col("id").alias(x), *[F.col(c).alias(f"{c[0]}{x}") for c in columns])


def _not_apart(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that the bitmaps of large sets do not rule out."""

    def run(batches):
        for batch in batches:
            la, lb = batch.column("la").to_pylist(), batch.column("lb").to_pylist()
            total = batch.column("na").to_numpy(False) + batch.column("nb").to_numpy(False)
            kept = [
                i for i, (x, y) in enumerate(zip(la, lb))
                if x is None or y is None or (100 + percent) * bits_apart(x, y) <= (100 - percent) * total[i]
            ]
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    large = members.where("large is not null")
    met = pairs.join(_side(large, "a", "n", "large"), "a", "left")
    met = met.join(_side(large, "b", "n", "large"), "b", "left")
    return met.select("a", "b", "na", "nb", "la", "lb").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, members: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) that link, by their whole sets; a staged table.

    Bitmaps rule out most pairs; only the sets of the others, which are far
    fewer, are made again and meet in full.
    """
    likely = stage(_not_apart(pairs, members, percent), "likely")
    wanted = likely.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    sets = stage(_hashes(docs.join(wanted, "doc_id", "left_semi"), k), "hashes")
    common = F.size(F.array_intersect("ha", "hb"))
    links = stage(
        likely.join(_side(sets, "a", "n", "hashes"), "a").join(_side(sets, "b", "n", "hashes"), "b")
        .where(100 * common >= percent * (F.col("na") + F.col("nb") - common))
        .select("a", "b"),
        "links",
    )
    drop(likely, sets)
    return links


def jaccard_components(
    df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of `df`; see the module's text."""
    docs = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if not repeated_ids(docs):
        return _components(docs, k, percent)
    # Rows are compared under numbers of their own, then components that share an id are joined.
    rows = stage(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    number = F.when(F.col("doc_id").isNotNull(), F.col("row"))
    found = _components(rows.select(number.alias("doc_id"), "text"), k, percent).select(
        F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("part")
    )
    found = stage(found.join(rows.select("row", "doc_id"), "row", "left"), "found")
    shared = found.where("doc_id is not null").groupBy("doc_id").agg(F.min("part").alias("a"))
    edges = found.join(shared, "doc_id").select("a", F.col("part").alias("b"))
    joined = components(edges).select(F.col("id").alias("part"), F.col("component_id").alias("whole"))
    parts = found.where("part is not null").groupBy("part").agg(F.min("doc_id").alias("least_id"))
    parts = parts.join(joined, "part", "left").withColumn("whole", F.coalesce("whole", "part"))
    least = parts.groupBy("whole").agg(F.min("least_id").alias("component_id"))
    of_part = parts.select("part", "whole").join(least, "whole").select("part", "component_id")
    return found.join(of_part, "part", "left").select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """`jaccard_components` of (doc_id, text) with unique ids."""
    sets = stage(_sets(docs, k), "sets")
    # Equal sets: the smallest id stands for all of them.
    leaders = stage(
        sets.where("n > 0 and doc_id is not null").groupBy("f1", "f2")
        .agg(F.min("doc_id").alias("id"), F.any_value("n").alias("n")),
        "leaders",
    )
    histogram = [
        (r[0], r[1])
        for r in leaders.groupBy(
            # Sizes over 200 in steps, so that the driver gets a bounded table.
            F.when(F.col("n") <= 200, F.col("n"))
            .otherwise(F.pow(F.lit(1.05), F.ceil(F.log(1.05, F.col("n")))).cast("bigint"))
            .alias("n")
        ).count().collect()
    ]
    largest = leaders.agg(F.max("n")).first()[0] or 0
    classes = Sizes(percent, choose_light(histogram, percent), int(largest))

    lead_ids = leaders.select(F.col("id").alias("doc_id"))
    copies = stage(
        sets.where("n > 0 and doc_id is not null").select("doc_id").join(lead_ids, "doc_id", "left_anti"),
        "copies",
    )
    if fits_broadcast(copies):
        # Texts stay where they are.
        lead_docs = docs.where("doc_id is not null").join(F.broadcast(copies), "doc_id", "left_anti")
    else:
        lead_docs = docs.join(lead_ids, "doc_id", "left_semi")
    rows = _keys(lead_docs, k, classes).select("id", F.explode("keys").alias("key"))
    in_key = Window.partitionBy("key").orderBy("id")
    listed = stage(
        rows.select(
            "key", "id",
            F.lag("id").over(in_key).alias("before"),
            F.lead("id").over(in_key).alias("after"),
            F.first("id").over(in_key).alias("head"),
        ).where("before <> id or after <> id").drop("after"),
        "lists",
    )
    members = stage(
        _members(
            docs.join(
                listed.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi"
            ), k,
        ),
        "members",
    )
    # Each set with the head it shares most lists with, and with its usual neighbour.
    counted = listed.select(
        F.col("id").alias("b"),
        F.explode(F.array(
            F.struct(F.lit(0).alias("kind"), F.col("head").alias("a")),
            F.struct(F.lit(1).alias("kind"), F.col("before").alias("a")),
        )).alias("x"),
    ).where("x.a < b").groupBy("b", "x").count()
    first_pairs = (
        counted.groupBy("b", "x.kind")
        .agg(F.max_by("x.a", F.struct("count", -F.col("x.a"))).alias("a")).select("a", "b").distinct()
    )
    small = members.select("id", "n", "bits")
    first_pairs = (
        first_pairs.join(_side(small, "a", "n", "bits"), "a").join(_side(small, "b", "n", "bits"), "b")
        .where(_may_link(percent)).select("a", "b")
    )
    first_links = _verified(first_pairs, members, docs, k, percent)
    found = components(first_links)

    # Lists that still hold several components are scanned in full.
    placed = listed.select("key", "id").join(found, "id", "left").select(
        "key", "id", F.coalesce("component_id", "id").alias("part")
    )
    mixed = placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).where(
        "p <> q"
    ).select("key")
    open_rows = stage(
        placed.join(mixed, "key", "left_semi").join(small, "id"), "open_lists"
    )
    side = lambda x: open_rows.select(
        "key", F.col("id").alias(x), F.col("part").alias(f"p{x}"), F.col("n").alias(f"n{x}"),
        F.col("bits").alias(f"b{x}"),
    )
    a, b = side("a"), side("b")
    pairs = (
        a.join(b, (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("pa") != F.col("pb"))
               & _may_link(percent))
        .select("a", "b").distinct()
    )
    links = _verified(pairs, members, docs, k, percent).union(first_links)
    # Only the links are read from here on.
    drop(listed, members, open_rows, copies)
    final = components(links)
    of_leader = (
        leaders.join(final, "id", "left")
        .select("f1", "f2", F.coalesce("component_id", "id").alias("component_id"))
    )
    return (
        sets.join(of_leader, ["f1", "f2"], "left")
        .select(
            "doc_id", F.col("n").alias("n_shingles"),
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        )
    )


def keep_one(df: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Documents that have the smallest id of their component, with all their columns.

    Rows without an id belong to no component and are all kept.
    """
    of = fresh(df, "kept_id")
    kept = (
        jaccard_components(df, k, percent).where("doc_id = component_id")
        .select(F.col("doc_id").alias(of)).distinct()
    )
    return df.join(kept, df["doc_id"] == kept[of], "left_semi").union(df.where("doc_id is null"))
