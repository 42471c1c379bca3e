"""Tables that are published only after they passed their gates.

A publication writes its tables beside the ones in use, checks them there, and
swaps them in by renames once all are good. Until the commit point, which is
one rename of a small manifest, nothing of the tables in use is touched: a gate
that fails or a run that dies leaves them as they were. After it the swap is
carried on by whoever comes next (`recover`), so a run that dies in the middle
of it cannot leave half a publication either.

Under `base`: `_next-<name>/` holds what is written, `_publish-<name>` is the
manifest, `_old-<name>/` what is being replaced. Names with a leading _ are
hidden from Spark's listings. A rename of a folder must be atomic, as on HDFS
or a local disk. One writer at a time per name.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from keelstone.functions.missing import column
from keelstone.operators.gates import DataQualityError, check_row_counts
from keelstone.sources.files import read_parquet

#: Ways to replace: the whole table, or only the partitions that were written.
TABLE, PARTITIONS = "table", "partitions"

Gate = Callable[[DataFrame], None]


class Written(NamedTuple):
    table: DataFrame
    rows: int
    metrics: dict[str, int]


class _Files:
    """The few file operations of a publication, by the Hadoop file system of the path."""

    def __init__(self, spark: SparkSession, base: str):
        context = spark.sparkContext
        self._jvm = context._jvm
        self._system = self._path(base).getFileSystem(context._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def folders(self, path: str) -> list[str]:
        return sorted(
            s.getPath().getName() for s in self._system.listStatus(self._path(path)) if s.isDirectory()
        )

    def make(self, path: str) -> None:
        self._system.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def rename(self, source: str, target: str) -> None:
        # Onto an existing folder a rename would move inside it.
        if self.exists(target) or not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def read(self, path: str) -> str:
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        stream = self._system.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()


class _Places(NamedTuple):
    manifest: str
    beside: str
    old: str


def _places(base: str, name: str) -> _Places:
    base = base.rstrip("/")
    return _Places(f"{base}/_publish-{name}", f"{base}/_next-{name}", f"{base}/_old-{name}")


def split_path(path: str) -> tuple[str, str]:
    """Folder and name of a table's path."""
    base, _, name = path.rstrip("/").rpartition("/")
    return base or ("/" if path.startswith("/") else "."), name


def recover(spark: SparkSession, base: str, name: str) -> bool:
    """Finish a swap that was committed, or clear away what was not; whether there was a swap."""
    files, at = _Files(spark, base), _places(base, name)
    committed = files.exists(at.manifest)
    if committed:
        for folder, entry in json.loads(files.read(at.manifest)).items():
            _swap(files, base.rstrip("/"), at, folder, entry["replace"], entry["emptied"])
        # From here on the old tables are not needed any more.
        files.delete(at.manifest)
    for path in (at.beside, at.old, f"{at.manifest}.part"):
        files.delete(path)
    return committed


def _swap(files: _Files, base: str, at: _Places, folder: str, replace: str, emptied: Sequence[str]) -> None:
    """Move what stands beside to its place; again and again with the same result."""
    source = f"{at.beside}/{folder}"
    if not files.exists(source):
        return
    if replace == TABLE:
        files.make(at.old)
        moves = [(source, f"{base}/{folder}", f"{at.old}/{folder}")]
    else:
        files.make(f"{base}/{folder}")
        files.make(f"{at.old}/{folder}")
        moves = [
            (f"{source}/{part}", f"{base}/{folder}/{part}", f"{at.old}/{folder}/{part}")
            for part in files.folders(source) if not part.startswith("_")
        ]
        for part in emptied:
            if files.exists(f"{base}/{folder}/{part}"):
                files.rename(f"{base}/{folder}/{part}", f"{at.old}/{folder}/{part}")
    for new, place, old in moves:
        # While the new one still stands beside, what is in place is the old one.
        if files.exists(place):
            files.rename(place, old)
        files.rename(new, place)


def current(spark: SparkSession, path: str, name: str | None = None) -> str:
    """Where a table is to be read just now: in the instant of a swap it still stands beside."""
    base, folder = split_path(path)
    files, at = _Files(spark, base), _places(base, name or folder)
    if not files.exists(path) and files.exists(at.manifest) and files.exists(f"{at.beside}/{folder}"):
        return f"{at.beside}/{folder}"
    return path


class Publication:
    """Tables that appear together, after all their gates."""

    def __init__(self, spark: SparkSession, base: str, name: str = "run"):
        self._spark, self._base, self._name = spark, base.rstrip("/"), name
        recover(spark, self._base, name)
        self._places = _places(self._base, name)
        self._tables: dict[str, tuple[dict, StructType]] = {}

    def write(
        self, df: DataFrame, folder: str, partition_by: str | None = None,
        metrics: Mapping[str, Column] | None = None, gates: Sequence[Gate] = (), replace: str = TABLE,
        covers: Iterable[str] = (), may_be_empty: bool = False,
    ) -> Written:
        """Write a table beside its place and check it there; see `sinks.parquet.write_checked`.

        `covers` names partition folders in use whose rows are all in `df`, as far
        as they remain: those that `df` has no rows of are removed. A table that
        `may_be_empty` passes the row count gate without rows.
        """
        if replace not in (TABLE, PARTITIONS) or (replace == PARTITIONS and partition_by is None):
            raise ValueError(f"cannot replace {replace} of {folder}")
        if folder in self._tables:
            raise ValueError(f"{folder} is written twice")
        path = f"{self._places.beside}/{folder}"
        counted = Observation()
        ready = df if partition_by is None else df.hint("rebalance", partition_by)
        more = [c.alias(n) for n, c in (metrics or {}).items()]
        writer = ready.observe(counted, F.count(F.lit(1)).alias("rows"), *more).write.mode("overwrite")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        writer.parquet(path)
        table = _read(self._spark, path, df.schema)
        before = counted.get.get("rows", 0)
        after = table.count()
        if before or after or not may_be_empty:
            check_row_counts(before, after)
        for gate in gates:
            gate(table)
        there = set(_Files(self._spark, self._base).folders(path)) if covers else set()
        self._tables[folder] = ({"replace": replace, "emptied": sorted(set(covers) - there)}, df.schema)
        return Written(table, before, {n: counted.get.get(n) or 0 for n in metrics or {}})

    def commit(self) -> dict[str, DataFrame]:
        """Swap all tables in; the tables at their places."""
        if not self._tables:
            raise DataQualityError("nothing was written")
        files, at = _Files(self._spark, self._base), self._places
        part = f"{at.manifest}.part"
        files.write(part, json.dumps({folder: entry for folder, (entry, _) in self._tables.items()}))
        files.rename(part, at.manifest)
        recover(self._spark, self._base, self._name)
        for folder in self._tables:
            # Spark may have listed the files that stood there before.
            self._spark.catalog.refreshByPath(f"{self._base}/{folder}")
        return {
            folder: _read(self._spark, f"{self._base}/{folder}", schema)
            for folder, (_, schema) in self._tables.items()
        }

    def abandon(self) -> None:
        """Remove what was written and not committed."""
        recover(self._spark, self._base, self._name)
        self._tables.clear()


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_parquet(spark, path, schema).select([column(c) for c in schema.fieldNames()])
