"""Operator 2: token-id files in ORC.

Documents are range-partitioned and sorted by id, encoded with the tokenizers
library, and written as ORC: the ids as a list of integers (run-length coded by
the format), a Bloom filter and row indexes on the document id, so a reader can
skip files, stripes and row groups by id and can split a file at its stripes.

Defined results: a null text is written like an empty one, as the end id alone;
rows with equal ids are ordered by a hash of their text; null ids come first.
Extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package, stage
from curbwise.llm.library import SLICE_BYTES, encoder

END_ID = 2
#: Rows between entries of the row index, and bytes of a stripe.
INDEX_STRIDE, STRIPE_BYTES = 10_000, 64 << 20


def encode(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", end: tuple[int, ...] = (END_ID,)
) -> DataFrame:
    """``df`` with the text replaced by its ids and the end ids."""
    ship_package(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def make():
        library = encoder(shared.value)
        return lambda part: [library.encode_all(part.column(text), list(end))]

    return arrow_pass(df, f"`{ids}` array<int>", make, drop=(text,), sized=(text, SLICE_BYTES))


def write_tokens(docs: DataFrame, path: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write ``doc_id``, ``place`` (ascending with the id) and ``ids`` as ORC files under ``path``.

    The text is sorted before it is encoded: it is smaller than the ids, and
    the range sampling then costs a scan and not an encoding.
    """
    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie").drop("tie")
    )
    tokens = encode(ordered, vocabulary).withColumn("place", F.monotonically_increasing_id())
    (
        tokens.select("doc_id", "place", "ids").write.option("compression", "zstd")
        .option("orc.create.index", "true").option("orc.row.index.stride", INDEX_STRIDE)
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files under ``path``; filters on ``doc_id`` reach the stripes and row groups."""
    return spark.read.schema("doc_id bigint, place bigint, ids array<int>").orc(path)


def token_positions(tokens: DataFrame) -> DataFrame:
    """Per document: ``start`` (ids before it in file order), ``n_tokens`` and ``ids_crc32``.

    Only the counts are kept, once, and shuffled. The upper bits of ``place`` name the file
    part, so the running sum is taken inside each part, and the parts' totals
    (one row each) carry it across them.
    """
    ship_package(tokens.sparkSession)

    def make():
        def compute(part: pa.RecordBatch) -> list:
            lists = part.column("ids")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].astype("<u4").tobytes()) for a, b in zip(offsets, offsets[1:], strict=False)]
            return [pa.array(np.diff(offsets).astype("i8")), pa.array(sums, pa.int64())]

        return compute

    counted = stage(arrow_pass(tokens, "n_tokens bigint, ids_crc32 bigint", make, drop=("ids",)), "token-counts")
    counted = counted.withColumn("part", F.shiftright("place", 33))
    inside = W.partitionBy("part").orderBy("place")
    running = counted.withColumn("upto", F.sum("n_tokens").over(inside))
    totals = counted.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = totals.select(
        "part", (F.sum("total").over(W.orderBy("part")) - F.col("total")).alias("before")
    )
    return running.join(before, "part").select(
        "doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32"
    )
