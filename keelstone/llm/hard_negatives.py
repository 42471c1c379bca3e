"""Hard negatives of anchor vectors by Fagin's threshold algorithm.

Every component is a list of the candidates in its order. For an anchor the
lists are read from the end that its component's sign favours, all to the same
depth; each row met for the first time is scored in full (random access). No
row further down can score more than the sum of the anchor's components times
the values at that depth. Reading stops once this threshold is strictly below
the kth score found, so rows that tie with the kth are always met; where fewer
than k are found, it stops below the least score that is wanted. Once fewer rows
are unseen than the lists' next entries, these rows are scored instead.

The rows are cut into blocks of `block_rows`, each with lists of its own, and
the anchors into groups of `group_anchors`. A task holds one block and one
group, and keeps the best k of each anchor or window; the k best of all blocks
are the result. Two passes are made: the positives of an anchor come from
blocks of its own label (a label of many rows has many blocks), the negatives
from blocks of all rows, for the score windows that the positives open. The
anchors are a stated query set: they meet every block, no pairs are joined.

Components are floored integers and scores are exact: in floating-point
arithmetic while all sums stay below 2^24 or 2^53, otherwise in unbounded
integers, which are held at the ends of a long.

Defined cases: rows with a NULL label, a NULL vector or a component that is
NULL or not finite take no part. Shorter vectors are filled up with zeros, so
an empty one scores 0. Ties go to the smaller vec_id, NULL ids last; NULL ids
are never anchors. Rows are told apart even if they are equal or share an id:
each is an anchor or candidate of its own. A window of a negative score is
empty. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from keelstone.llm.shared import stage

SCALE = 256
BLOCK_ROWS, GROUP_ANCHORS = 4096, 1024
# Entries read of each list before the threshold is looked at first; then twice as many each time.
FIRST_DEPTH = 16
_EXACT_SHORT, _EXACT = 1 << 24, 1 << 53
_LONG = (1 << 63) - 1


class Lists:
    """Rows of a block with two lists per component: highest value first, and lowest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        down = np.argsort(-vectors, axis=0, kind="stable").T.astype(np.int32)
        self.lists = np.stack([down, down[:, ::-1]])
        self.most = float(np.abs(vectors).max(initial=0.0))
        self.short = vectors.astype(np.float32)

    def __len__(self) -> int:
        return len(self.ids)

    def best(
        self, anchor: np.ndarray, windows: list[tuple[int, int]], k: int, wanted: np.ndarray | None = None
    ) -> list[list[tuple[int, int]]]:
        """(score, row) of the first `k` rows in each window of scores (least, most).

        Only rows set in `wanted` count.
        """
        n = len(self)
        live = [(least, most) for least, most in windows if least <= most]
        if not n or not live:
            return [[] for _ in windows]
        used = np.flatnonzero(anchor)
        # A negative component favours the other end of its list.
        side = (anchor[used] < 0).astype(np.intp)
        bound = self.most * float(np.abs(anchor).sum())
        seen = np.zeros(n, dtype=bool)
        rows, scores = [], []
        depth, step = 0, FIRST_DEPTH
        floor, ceiling = min(least for least, _ in live), min(most for _, most in live)
        while depth < n:
            # Fewer rows are left than the next entries of the lists: score them all.
            stop = n if n - seen.sum() <= len(used) * step else min(n, depth + step)
            if stop == n or not len(used):
                stop, new = n, ~seen
            else:
                new = np.zeros(n, dtype=bool)
                new[self.lists[side, used, depth:stop]] = True
                new &= ~seen
            seen |= new
            at = np.flatnonzero(new if wanted is None else new & wanted)
            found = self._scores(at, anchor, bound)
            keep = found >= floor
            rows.append(at[keep])
            scores.append(found[keep])
            depth, step = stop, step * 2
            if seen.all():
                break
            edge = self.vectors[self.lists[side, used, depth - 1], used]
            threshold = self._threshold(edge, anchor[used], bound)
            # No kth score is above the top of its window.
            if threshold < ceiling:
                so_far = np.sort(np.concatenate(scores))
                if all(threshold < self._kth(so_far, w, k) for w in live):
                    break
        rows, scores = np.concatenate(rows), np.concatenate(scores)
        so_far = np.sort(scores)
        out = []
        for least, most in windows:
            pick = np.flatnonzero((scores >= self._kth(so_far, (least, most), k)) & (scores <= most))
            first = np.lexsort((self.ids[rows[pick]], -scores[pick]))[:k]
            out.append([(int(scores[pick[i]]), int(rows[pick[i]])) for i in first])
        return out

    def _scores(self, at: np.ndarray, anchor: np.ndarray, bound: float) -> np.ndarray:
        """Inner products of rows with an anchor; all sums are at most `bound`."""
        if bound < _EXACT_SHORT:
            return (self.short[at] @ anchor.astype(np.float32)).astype(np.int64)
        if bound < _EXACT:
            return (self.vectors[at] @ anchor).astype(np.int64)
        weights = [int(x) for x in anchor]
        sums = [sum(int(v) * w for v, w in zip(row, weights)) for row in self.vectors[at].tolist()]
        return np.array([max(-_LONG, min(_LONG, s)) for s in sums], dtype=np.int64)

    @staticmethod
    def _threshold(edge: np.ndarray, weights: np.ndarray, bound: float) -> int:
        if bound < _EXACT:
            return int(edge @ weights)
        return max(-_LONG, min(_LONG, sum(int(v) * int(w) for v, w in zip(edge, weights))))

    @staticmethod
    def _kth(scores: np.ndarray, window: tuple[int, int], k: int) -> int:
        """The kth of the sorted scores inside a window, or its least score."""
        low, high = np.searchsorted(scores, window[0]), np.searchsorted(scores, window[1], side="right")
        return int(scores[high - k]) if high - low >= k else window[0]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, vector in enumerate(column.to_pylist()):
        out[i, : len(vector)] = vector
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max((len(v) for c in columns for v in c.to_pylist()), default=0)


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    """Ids for ties; NULL comes last."""
    return np.array([_LONG if x is None else x for x in column.to_pylist()], dtype=np.int64)


def prepared(vectors: DataFrame, anchors: Column) -> DataFrame:
    """The rows that take part, floored and numbered; written once."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    ).where("label is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # A product and not a call of floor(): its result would have to fit a long.
    floored = F.transform("vector", lambda x: _floored(x.cast("double") * SCALE))
    numbered = rows.where(finite).withColumn("vector", floored)
    return stage(numbered.withColumn("row", F.monotonically_increasing_id()), "vectors")


def _floored(x: Column) -> Column:
    return F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x)


def _in_blocks(
    rows: DataFrame, queries: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str, keys: list[str]
) -> DataFrame:
    # Both sides come from one table: new columns keep them apart.
    left, right = rows.groupBy(*keys), queries.toDF(*queries.columns).groupBy(*keys)
    return left.cogroup(right).applyInArrow(work, schema)


def _positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {n: [] for n in ("anchor", "row", "vec_id", "score")}
        if len(block) and len(anchors):
            width = _width(block["vector"], anchors["vector"])
            lists = Lists(_ids(block["vec_id"]), _matrix(block["vector"], width))
            names, numbers = block["vec_id"].to_pylist(), block["row"].to_numpy()
            for anchor, vector in zip(anchors["row"].to_pylist(), _matrix(anchors["vector"], width)):
                for score, at in lists.best(vector, [(-_LONG, _LONG)], k, numbers != anchor)[0]:
                    for name, value in zip(out, (anchor, int(numbers[at]), names[at], score)):
                        out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return work


def _negatives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def work(block: pa.Table, anchors: pa.Table) -> pa.Table:
        out = {n: [] for n in ("anchor", "positive", "vec_id", "score")}
        if len(block) and len(anchors):
            width = _width(block["vector"], anchors["vector"])
            lists = Lists(_ids(block["vec_id"]), _matrix(block["vector"], width))
            names = block["vec_id"].to_pylist()
            labels = np.array(block["label"].to_pylist(), dtype=object)
            others = {label: labels != label for label in set(anchors["label"].to_pylist())}
            for anchor, label, vector, windows in zip(
                anchors["row"].to_pylist(), anchors["label"].to_pylist(),
                _matrix(anchors["vector"], width), anchors["windows"].to_pylist(),
            ):
                limits = [(w["least"], w["most"]) for w in windows]
                for window, best in zip(windows, lists.best(vector, limits, k, others[label])):
                    for score, at in best:
                        for name, value in zip(out, (anchor, window["positive"], names[at], score)):
                            out[name].append(value)
        return pa.table({n: pa.array(v, pa.int64()) for n, v in out.items()})

    return work


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best rows of each key, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    block_rows: int = BLOCK_ROWS, group_anchors: int = GROUP_ANCHORS,
) -> DataFrame:
    """Hard negatives of the rows for which `anchors` is true.

    `vectors` has vec_id, label and embedding. An anchor's positives are its
    first `positives` other rows of its label; its negatives for a positive are
    the first `negatives` rows of other labels whose score is `low` to `high`
    percent of the positive's. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    rows = prepared(vectors, anchors)
    total, asked = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor")).first()
    blocks, groups = max(1, -(-total // block_rows)), max(1, -(-asked // group_anchors))
    number = F.xxhash64("row")
    plain = rows.select("row", "vec_id", "label", "vector", "is_anchor")

    # First pass: blocks and groups inside each label.
    parts = rows.groupBy("label").agg(
        F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count_if("is_anchor") / group_anchors)).alias("groups"),
        F.count_if("is_anchor").alias("asked"),
    ).where("asked > 0")
    spread = plain.join(parts, "label")
    own, other = F.pmod(number, F.col("blocks")), F.pmod(number, F.col("groups"))
    keys = ["label", "block", "group"]
    cells = spread.select(
        "row", "vec_id", "vector", "label", own.alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"),
    )
    asking = spread.where("is_anchor").select(
        "row", "vector", "label", other.alias("group"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
    )
    local = _in_blocks(
        cells, asking, _positives(positives), "anchor long, row long, vec_id long, score long", keys
    )
    best = _first(local, ["anchor"], positives)

    # A window per positive: low * positive <= 100 * score <= high * positive, in whole numbers.
    score = F.col("score").cast("decimal(38,0)")
    least = F.ceil(score * low / 100).cast("long")
    most = F.floor(score * high / 100).cast("long")
    opened = stage(
        best.withColumn("least", least).withColumn("most", most).where("least <= most"), "positives"
    )
    windows = opened.groupBy("anchor").agg(
        F.collect_list(F.struct(F.col("row").alias("positive"), "least", "most")).alias("windows")
    )

    # Second pass: blocks of all rows.
    asking = (
        plain.where("is_anchor").join(windows, F.col("row") == F.col("anchor"))
        .select(
            "row", "label", "vector", "windows", F.pmod(number, F.lit(groups)).alias("group"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        )
    )
    cells = plain.select(
        "row", "vec_id", "label", "vector", F.pmod(number, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
    )
    local = _in_blocks(
        cells, asking, _negatives(negatives), "anchor long, positive long, vec_id long, score long",
        ["block", "group"],
    )
    found = _first(local, ["anchor", "positive"], negatives).select(
        "anchor", "positive", "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    anchor_ids = rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        found.join(
            opened.select(
                "anchor", F.col("row").alias("positive"), F.col("vec_id").alias("positive_id"),
                F.col("score").alias("positive_score"),
            ),
            ["anchor", "positive"],
        )
        .join(anchor_ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
