"""Replacing a span of a table's partitions as a whole, empty ones included.

Dynamic overwrite replaces the partitions that the new rows have and leaves the
others, so a day that lost all its orders would keep its old ones. Here the new
rows are first written to a hidden folder inside the table; then a manifest
names the partitions of the span and those that were written, and from then on
the replacement is decided: each partition of the span is dropped, and moved in
if it is among the written. Whoever next replaces or reads through ``settled``
finishes a replacement that was cut off after its manifest and clears away one
that was cut off before it. Folders are moved, not rewritten; the driver
handles names of partitions only.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_STAGED, _MANIFEST = "_staged-", "_replace-"


class _Files:
    """The few file-system calls a replacement needs, on whatever store the path is in."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm = spark.sparkContext._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.store = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *names: str):
        path = self.root
        for name in names:
            path = self.jvm.org.apache.hadoop.fs.Path(path, name)
        return path

    def names(self, *folder: str) -> list[str]:
        path = self.path(*folder)
        return [each.getPath().getName() for each in self.store.listStatus(path)] if self.store.exists(path) else []

    def exists(self, *names: str) -> bool:
        return self.store.exists(self.path(*names))

    def drop(self, *names: str) -> None:
        self.store.delete(self.path(*names), True)

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        if not self.store.rename(self.path(*source), self.path(*target)):
            raise OSError(f"cannot move {'/'.join(source)} in {self.root}")

    def write(self, text: str, name: str) -> None:
        """The whole text appears under the name, or nothing."""
        self.store.mkdirs(self.root)
        out = self.store.create(self.path(f"_new{name}"))
        out.write(bytearray(text, "utf-8"))
        out.close()
        self.move((f"_new{name}",), (name,))

    def read(self, name: str) -> str:
        stream = self.store.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    return _Files(spark, path).exists()


def gathered(rows: DataFrame, column: str, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a partition side by side, a large one split by size; sorted in each file if there is an ``order``."""
    rows = rows.hint("rebalance", column)
    return rows.sortWithinPartitions(column, *order) if order else rows


def replace_partitions(rows: DataFrame, path: str, column: str, span: list[str], order: tuple[str, ...] = ()) -> None:
    """Replace the partitions ``column`` = each of ``span`` by ``rows``, which have no others.

    A partition of the span without rows is gone afterwards; partitions outside
    of it stay. A job that fails leaves the table as it was. One replacement of
    a table runs at a time.
    """
    spark = rows.sparkSession
    settled(spark, path)
    name = uuid.uuid4().hex
    staged = f"{_STAGED}{name}"
    gathered(rows, column, order).write.partitionBy(column).parquet(f"{path.rstrip('/')}/{staged}")
    files = _Files(spark, path)
    written = [each for each in files.names(staged) if each.startswith(f"{column}=")]
    wanted = [f"{column}={value}" for value in span]
    strange = sorted(set(written).difference(wanted))
    if strange:
        files.drop(staged)
        raise ValueError(f"rows outside the span: {', '.join(strange[:5])}")
    manifest = {"staged": staged, "span": wanted, "written": written}
    files.write(json.dumps(manifest), f"{_MANIFEST}{name}")
    settled(spark, path)


def settled(spark: SparkSession, path: str) -> str:
    """``path``, after finishing decided replacements and clearing undecided ones."""
    files = _Files(spark, path)
    for name in files.names():
        if name.startswith(_MANIFEST):
            _apply(files, json.loads(files.read(name)))
            files.drop(name)
    for name in files.names():
        if name.startswith((_STAGED, f"_new{_MANIFEST}")):
            files.drop(name)
    return path


def _apply(files: _Files, manifest: dict) -> None:
    """Can be cut off and done again: a partition that was already moved is no longer in the staged folder."""
    staged = manifest["staged"]
    for partition in manifest["span"]:
        if partition not in manifest["written"]:
            files.drop(partition)
        elif files.exists(staged, partition):
            files.drop(partition)
            files.move((staged, partition), (partition,))
    files.drop(staged)
