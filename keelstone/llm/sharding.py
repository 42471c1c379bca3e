"""Shards of near-equal bytes by k-d tree partitioning.

Rows are points in a space of metadata: size, source, language and text
checksum, each scaled to 20 bits. A node with the bytes of several shards is
split along its widest dimension at a weighted median (weights are bytes; a
node for an odd number of shards is split in proportion), until its bytes
reach the target. Only the tree, one row per split, is held by the driver.

The medians are found by digits: a pass sums the bytes of each node by one
digit of its split dimension, all nodes of a level together, and the digit
that holds the median is refined by the next one. Equal values are split by
checksum and then by id, so rows of equal text stay together unless their group
itself crosses a border of bytes; any group may thus hold a third of all rows.
Passes stop when a digit holds less than `TOLERANCE` of a shard.

Defined cases: NULL and empty texts have size 1. NULL source and language are a value
of their own. Repeated rows and ids go where the first of them goes, as long as
checksum and id agree, and share no slot. Extra columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from keelstone.llm.shared import stage

AXIS_BITS = 20
DIGIT_BITS = 10
TOLERANCE = 0.002
LEAST = -(2**63)
SLOT_ROWS = 1_000_000  # rows numbered by one task
AXES = ("size_axis", "source_axis", "lang_axis", "text_axis")


@dataclass
class Split:
    axis: str
    key: int  # rows below (key, doc_id) go left
    doc_id: int


def points(docs: DataFrame) -> DataFrame:
    """Metadata of every row: doc_id, size, text_crc32 and the axes."""
    text = F.coalesce(F.col("text"), F.lit(""))


    def spread(name: str) -> Column:
        value = F.coalesce(F.col(name).cast("string"), F.lit("\0"))
        return F.pmod(F.xxhash64(value), F.lit(1 << AXIS_BITS))

    size = (F.octet_length(text) + 1).cast("bigint")
    crc = F.crc32(text)
    columns = [
        F.col("doc_id").cast("bigint").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"),
        F.least(F.lit((1 << AXIS_BITS) - 1), F.floor(F.log2(size) * (1 << (AXIS_BITS - 5))))
        .cast("bigint").alias("size_axis"),
        (spread("source") if "source" in docs.columns else F.lit(0).cast("bigint")).alias("source_axis"),
        (spread("lang") if "lang" in docs.columns else F.lit(0).cast("bigint")).alias("lang_axis"),
        F.shiftright(crc, 32 - AXIS_BITS).alias("text_axis"),
    ]
    return docs.select(*columns)


def _key(axis: Column) -> Column:
    """Value on an axis, given by its number, then checksum."""
    return F.shiftleft(F.get(F.array(*AXES), axis.cast("int")), 32) + F.col("text_crc32")


KEY_BITS = AXIS_BITS + 32


class Tree:
    """Splits by node number; the root is 1, the sides of node i are 2i and 2i + 1."""

    def __init__(self, shards: int):
        self.splits: dict[int, Split] = {}
        self.shares = {1: shards}  # shards below a node
        self.firsts = {1: 0}

    def descend(self, rows: DataFrame, depth: int) -> DataFrame:
        """Rows with their node one level further down, written once for the passes of that level."""
        level = {i: s for i, s in self.splits.items() if i.bit_length() - 1 == depth}
        if not level:
            return rows
        node = F.col("node")
        axis = _by_node({i: AXES.index(s.axis) for i, s in level.items()}, node)
        key, cut = _by_node({i: s.key for i, s in level.items()}, node), _key(axis)
        left = (cut < key) | (
            (cut == key)
            & (F.coalesce("doc_id", F.lit(LEAST)) < _by_node({i: s.doc_id for i, s in level.items()}, node))
        )
        below = F.when(axis.isNull(), node).when(left, 2 * node).otherwise(2 * node + 1)
        return stage(rows.withColumn("node", below.cast("bigint")), "nodes")


def _by_node(values: dict[int, int], node: Column) -> Column:
    """Value of a row's node, NULL for a node that has none."""
    pairs = [F.lit(x).cast("bigint") for pair in values.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), node)


def grow(meta: DataFrame, shards: int) -> tuple[Tree, DataFrame]:
    """Tree for `shards` leaves of near-equal bytes, and the rows with their leaf as `node`."""
    tree, depth = Tree(shards), 0
    rows = meta.withColumn("node", F.lit(1).cast("bigint"))
    while any(n > 1 for i, n in tree.shares.items() if i.bit_length() - 1 == depth):
        stats = rows.groupBy("node").agg(
            F.sum("size").alias("bytes"),
            *[F.min(a).alias(f"min_{a}") for a in AXES], *[F.max(a).alias(f"max_{a}") for a in AXES],
        ).collect()
        nodes = {}
        for s in stats:
            i = s["node"]
            if i.bit_length() - 1 != depth or tree.shares[i] < 2:
                continue
            share = tree.shares[i]
            nodes[i] = {
                "axis": max(AXES, key=lambda a: s[f"max_{a}"] - s[f"min_{a}"]),
                "want": s["bytes"] * (share // 2) // share,
                "slack": TOLERANCE * s["bytes"] / share,
            }
        tree.splits.update(_medians(rows, nodes))
        for i in [i for i, n in tree.shares.items() if n > 1 and i.bit_length() - 1 == depth]:
            share, first = tree.shares[i], tree.firsts[i]
            if i not in tree.splits:  # a node without rows
                tree.splits[i] = Split(AXES[0], 0, 0)
            tree.shares[2 * i], tree.shares[2 * i + 1] = share // 2, share - share // 2
            tree.firsts[2 * i], tree.firsts[2 * i + 1] = first, first + share // 2
        rows = tree.descend(rows, depth)
        depth += 1
    return tree, rows


def _medians(rows: DataFrame, nodes: dict[int, dict]) -> dict[int, Split]:
    """Split of every node: the point where the bytes before it come closest to what is wanted."""
    out: dict[int, Split] = {}
    # Of nodes still searched: the digits found so far, and the bytes before them.
    prefix, before = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    bits, ties = 0, {}
    while prefix:
        step = min(DIGIT_BITS, KEY_BITS - bits)
        node = F.col("node")
        key = _key(_by_node({i: AXES.index(nodes[i]["axis"]) for i in prefix}, node))
        found = (
            rows.where(F.shiftright(key, KEY_BITS - bits) == _by_node(prefix, node))
            .groupBy("node", F.shiftright(key, KEY_BITS - bits - step).alias("digit"))
            .agg(F.sum("size").alias("bytes")).collect()
        )
        bits += step
        for i in list(prefix):
            want, slack = nodes[i]["want"], nodes[i]["slack"]
            passed, value, size = before[i], 0, 0
            for value, size in sorted((r["digit"], r["bytes"]) for r in found if r["node"] == i):
                if passed + size > want:
                    break
                passed += size
            if size <= slack and bits < KEY_BITS:
                # Close enough: cut at the nearer end of this digit.
                up = passed + size - want < want - passed
                out[i] = Split(nodes[i]["axis"], (value + up) << (KEY_BITS - bits), LEAST)
                del prefix[i]
            elif bits == KEY_BITS:
                ties[i] = {"key": value, "before": passed}
                del prefix[i]
            else:
                prefix[i], before[i] = value, passed
    out.update(_tie_splits(rows, nodes, ties))
    return out


def _tie_splits(rows: DataFrame, nodes: dict[int, dict], ties: dict[int, dict]) -> dict[int, Split]:
    """Cut groups of one key by id, by halving the range of ids in digits."""
    out = {}
    for i, tie in ties.items():
        axis, want = nodes[i]["axis"], nodes[i]["want"]
        same_key = _key(F.lit(AXES.index(axis))) == tie["key"]
        group = rows.where((F.col("node") == i) & same_key).select(
            F.coalesce("doc_id", F.lit(LEAST)).alias("id"), "size"
        )
        low, high = group.agg(F.min("id"), F.max("id")).first()
        before = tie["before"]
        while True:
            width = max((high - low) // 1024 + 1, 1)
            bins = sorted(
                group.where(F.col("id").between(low, high))
                .groupBy(F.expr(f"cast(floor((id - {low}L) / {width}) as bigint)").alias("bin"))
                .agg(F.sum("size").alias("bytes")).collect()
            )
            for number, size in bins:
                if before + size > want:
                    break
                before += size
            else:
                number, size = number + 1, 0
            start = low + number * width
            if width == 1 or size <= nodes[i]["slack"]:
                up = before + size - want < want - before
                out[i] = Split(axis, tie["key"], start + up * width)
                break
            low, high = start, min(high, start + width - 1)
    return out


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row; slots of a shard have no gaps."""
    meta = stage(points(docs), "points")
    n_rows, total = meta.agg(F.count(F.lit(1)), F.sum("size")).first()
    if shards is None:
        shards = max(1, -(-(total or 0) // target_bytes))
    tree, placed = grow(meta, shards)
    firsts = {i: tree.firsts[i] for i, n in tree.shares.items() if n == 1}
    chunks = max(1, -(-n_rows // (shards * SLOT_ROWS)))
    rows = placed.select(
        "doc_id", "size", "text_crc32",
        _by_node(firsts, F.col("node")).alias("shard"),
        F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"),
    )
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "chunk").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot")
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("_nth", F.row_number().over(inside) - 1)
        .join(offsets, ["shard", "chunk"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("_nth")).alias("slot"))
    )
