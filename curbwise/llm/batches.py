"""Shared plumbing: table access, hash folds and Arrow passes over text columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbwise.session import ship_package, stage

#: Rows handed to Python code at once; bounds what a worker holds beside the Arrow batch.
ROWS = 512

#: Bytes of a text to bytes of its words: other ASCII becomes a space, A-Z lower case.
_FOLD = bytes(
    byte if byte >= 0x80 or chr(byte).isdigit() else ord(chr(byte).lower()) if chr(byte).isalpha() else 0x20
    for byte in range(256)
)

__all__ = ["arrow_pass", "fold", "numbered", "ship_package", "slices", "slices_by_size", "stage", "table", "texts", "words_of", "ROWS"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % modulus, F.lit(-1))


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def slices_by_size(batches: Iterable[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices whose strings in ``column`` have ``most`` bytes together, or more by their last row only."""
    for batch in batches:
        if batch.num_rows:
            sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes, dtype=np.int64) // most
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for at, end in zip(cuts, cuts[1:], strict=False):
                yield batch.slice(at, end - at)


def texts(part: pa.RecordBatch, column: str) -> list[str]:
    """The column's values; null reads as empty."""
    return ["" if value is None else value for value in part.column(column).to_pylist()]


def words_of(data: bytes | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    return (data or b"").translate(_FOLD).split()


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns named by place, which no column of an operator clashes with, and the new name of each."""
    names = {name: f"column {place}" for place, name in enumerate(df.columns)}
    return df.toDF(*names.values()), names


def arrow_pass(
    df: DataFrame, added: str, make: Callable[[], Callable[[pa.RecordBatch], list]], drop: tuple[str, ...] = (),
    sized: tuple[str, int] | None = None,
) -> DataFrame:
    """Append columns computed from slices of rows, without any shuffle.

    ``make`` runs once per task and returns the function from a slice to one
    array per added column (``added`` is a DDL string). Columns named in
    ``drop`` are left out of the result; so are columns with the name of an
    added one (whatever its case), which the added one replaces as in
    ``withColumn``. The rest pass through untouched. ``sized`` (column, bytes)
    cuts the slices by the size of a string column and not by rows.
    """
    new = T._parse_datatype_string(added)
    replaced = {name.lower() for name in new.fieldNames()}
    kept = [field for field in df.schema.fields if field.name not in drop and field.name.lower() not in replaced]
    names = [field.name for field in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        for part in slices_by_size(batches, *sized) if sized else slices(batches):
            compute = compute or make()
            columns = [part.column(name) for name in names] + compute(part)
            yield pa.RecordBatch.from_arrays(columns, names + new.fieldNames())

    return df.mapInArrow(run, T.StructType(kept + new.fields))
