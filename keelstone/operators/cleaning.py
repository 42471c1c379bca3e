"""Row-level cleaning: missing values, duplicates, empty text."""

from __future__ import annotations

from collections.abc import Sequence
from threading import Lock
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from keelstone import scratch
from keelstone.functions import text
from keelstone.functions.missing import any_missing, column
from keelstone.operators import profile, skew


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in `subset`.

    None looks at every column; an empty list drops nothing.
    """
    return df.where(~any_missing(df, df.columns if subset is None else subset))


def fill_zero(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace NULL and NaN in numeric columns by zero."""
    return df.fillna(0, subset=None if subset is None else list(subset))


def empty_to_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.withColumns({n: text.empty_to_null(column(n)) for n in subset})


def _required(keys: Sequence[str]) -> list[str]:
    if isinstance(keys, str) or not keys:
        raise ValueError("deduplication needs a list of at least one key column")
    return list(keys)


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One arbitrary row per key. Its choice may differ between two runs."""
    return df.dropDuplicates(_required(keys))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The first row of each key by `order`, then by all other columns.

    The order is total, so every run, retry and reader gets the same row. It is
    an aggregate and not a ranking window: the copies of a key are reduced to
    one before the shuffle, so no task has to hold a large group.
    """
    keys = _required(keys)
    ranked = [c for c in order if c not in keys]
    ranked += [c for c in df.columns if c not in keys and c not in ranked]
    if not ranked:
        return df.select([column(k) for k in keys]).distinct()
    first = df.groupBy(*[column(k) for k in keys]).agg(
        F.min(F.struct(*[column(c) for c in ranked])).alias("_first")
    )
    inner = {c: F.col("_first").getField(c).alias(c) for c in ranked}
    return first.select([inner[c] if c in inner else column(c) for c in df.columns])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.select([column(c) for c in columns or df.columns]).distinct()


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(column(name)).distinct()


def key_counts(df: DataFrame, keys: Sequence[str], count_name: str = "copies") -> DataFrame:
    return df.groupBy(*[column(k) for k in _required(keys)]).agg(
        F.count(F.lit(1)).alias(count_name)
    )


def repeated_rows(df: DataFrame, keys: Sequence[str], **options) -> DataFrame:
    """All rows whose key occurs more than once.

    Of a whole row as key only the fingerprint is shuffled first; see `profile.repeated_groups`.
    """
    keys = _required(keys)
    if set(keys) == set(df.columns) and len(keys) > profile.NARROW_COLUMNS:
        groups = profile.repeated_groups(df, keys, **options)
        one = F.lit(1).cast("long")
        copies = groups.withColumn("_copy", F.explode(F.sequence(one, F.col("_n"))))
        return copies.select([column(c) for c in df.columns])
    repeated = key_counts(df, keys, "_copies").where(F.col("_copies") > 1)
    return skew.semi_join(df, repeated, keys, "_copies", **options)


class Cleaned(NamedTuple):
    frame: DataFrame
    report: DataFrame


class Counted:
    """A cleaned frame with counts of what its cleaning did, carried as data.

    Every row kept knows how many rows it stands for, and the rows with missing
    keys are reduced to a number beside the row without a key; all of this goes
    through the one aggregate that removes the duplicates. Nothing but the keys
    groups it, so a single one is all that its sorts compare. The counts are sums over the
    staged result. So they follow the rules of data: the output of a map task
    that runs again replaces the first one, while an accumulator before the
    shuffle would add it twice.
    """

    def __init__(
        self, df: DataFrame, missing_keys: Sequence[str] = (), dup_keys: Sequence[str] | None = None,
        label: str = "cleaned",
    ):
        self._missing_keys, self._columns = list(missing_keys), df.columns
        self._lost = any_missing(df, missing_keys)
        self._df, self._keys, self._label = df, dup_keys, label
        self._staged: DataFrame | None = None
        self._lock = Lock()

    def _reduced(self) -> DataFrame:
        """Rows of `df` with `_copies`, none in a row not kept, and the `_dropped` lost ones beside them."""
        flagged, lost = self._df.withColumn("_lost", self._lost), F.col("_lost")
        if self._keys is None:
            # Nothing is shuffled but the count of the lost rows.
            none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
            kept = flagged.where(~lost).drop("_lost").withColumns({"_copies": one, "_dropped": none})
            count = flagged.where(lost).agg(F.count(F.lit(1)).alias("_dropped"))
            nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self._df.schema]
            return kept.union(count.select(*nothing, none, "_dropped").where("_dropped > 0"))
        keys = _required(self._keys)
        rest = [c for c in self._columns if c not in keys]
        # A lost row has no key, and no values to be the first of.
        narrowed = flagged.select(
            *[F.when(~lost, column(k)).alias(k) for k in keys], *[column(c) for c in rest], "_lost"
        )
        first = F.min(F.when(~lost, F.struct(*[column(c) for c in rest]))) if rest else F.lit(None)
        groups = narrowed.groupBy(*[column(k) for k in keys]).agg(
            first.alias("_first"), F.count_if(~lost).alias("_copies"), F.count_if(lost).alias("_dropped")
        )
        inner = {c: F.col("_first").getField(c).alias(c) for c in rest}
        return groups.select(
            *[inner[c] if c in inner else column(c) for c in self._columns], "_copies", "_dropped"
        )

    @property
    def staged(self) -> DataFrame:
        """The kept rows and their counts, written once by the first to ask."""
        with self._lock:
            if self._staged is None:
                self._staged = scratch.stage(self._reduced(), self._label)
            return self._staged

    @property
    def frame(self) -> DataFrame:
        """The cleaned rows."""
        return self.staged.where("_copies > 0").select([column(c) for c in self._columns])

    def counts(self) -> dict[str, int]:
        """rows_in, missing_dropped, duplicates_dropped, rows_out."""
        lost, copies = F.col("_dropped"), F.col("_copies")
        found = self.staged.agg(
            F.sum(copies + lost).alias("rows_in"), F.sum(lost).alias("missing_dropped"),
            F.sum(F.when(copies > 0, copies - F.lit(1))).alias("duplicates_dropped"),
            F.count_if(copies > 0).alias("rows_out"),
        ).first()
        return {name: value or 0 for name, value in found.asDict().items()}


def clean(
    df: DataFrame,
    missing_keys: Sequence[str] = (),
    dup_keys: Sequence[str] | None = None,
    order: Sequence[str] = (),
) -> Cleaned:
    """Drop rows with missing keys, then keep one row per duplicate key.

    `dup_keys=None` leaves duplicates alone. The report (step, row_count) is
    lazy: nothing is counted unless it is used. See `profile.missing_profile`
    for the per-column picture that usually precedes cleaning.
    """
    kept = drop_missing(df, missing_keys)
    result = kept if dup_keys is None else keep_first(kept, dup_keys, order)
    counts = profile.dropped_by_missing(df, missing_keys)
    steps = [("rows_in", F.col("rows_in")), ("missing_dropped", F.col("rows_dropped"))]
    report = counts.select(
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("step"), n.alias("row_count")) for s, n in steps])
        )
    )
    if dup_keys is not None:
        dups = profile.surplus_rows(kept, dup_keys)
        steps = [("duplicates_dropped", F.col("surplus")), ("rows_out", F.col("key_count"))]
        report = report.union(
            dups.select(
                F.inline(
                    F.array(
                        *[F.struct(F.lit(s).alias("step"), n.alias("row_count")) for s, n in steps]
                    )
                )
            )
        )
    return Cleaned(result, report)
