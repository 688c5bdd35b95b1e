"""Operator 5: benchmark decontamination with a broadcast set of n-grams.

A text's words are runs of ASCII letters and digits and any non-ASCII
characters, with A-Z lower-cased. A benchmark item's windows are its runs of ten
words; an item of one to nine words is a single window. Word numbers, window
hashes and the windows themselves are broadcast; each document's windows are
hashed in one vectorised step, looked up in the sorted hashes, and every hit is
verified on its word numbers, so a hash collision never counts.

A broadcast holds at most ``BLOCK_WINDOWS`` windows. A larger benchmark is split
into blocks of whole items; the documents pass each block in turn, with the
marks so far written to the shared folder in between, and the result is the same.

Defined results: null texts have no words; benchmark items without words have no
windows; a null item id is written as ``null``; repeated items and repeated rows
each count as they stand, while ``n_items`` counts distinct ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package, stage, words_of

WINDOW = 10
#: Windows in one broadcast: some 200 bytes each, so about 40 MB.
BLOCK_WINDOWS = 200_000

_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit polynomial hash of every window of ``size`` codes."""
    count = len(codes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    hashed = np.zeros(count, np.uint64)
    for at in range(size):
        hashed = hashed * _BASE + codes[at:at + count].astype(np.uint64) + np.uint64(1)
    return hashed


class Block:
    """Some items' windows: word numbers, and per window size the sorted hashes with their windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]]) -> None:
        self.codes: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        self.windows: dict[tuple[int, ...], list[int]] = {}
        for place, (_, words) in enumerate(items):
            codes = tuple(self.codes.setdefault(word, len(self.codes)) for word in words)
            size = min(WINDOW, len(codes))
            for at in range(len(codes) - size + 1):
                owners = self.windows.setdefault(codes[at:at + size], [])
                if not owners or owners[-1] != place:
                    owners.append(place)
        self.hashes = {
            size: np.unique(np.concatenate([
                window_hashes(np.array(window, np.int64), size) for window in self.windows if len(window) == size
            ]))
            for size in sorted({len(window) for window in self.windows})
        }

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurring window, and the ids of the items they come from."""
        codes = np.array([self.codes.get(word, -1) for word in words], np.int64)
        edges = np.zeros(len(codes) + 1, np.int32)
        items: set[str] = set()
        for size, known in self.hashes.items():
            hashed = window_hashes(codes, size)
            if not len(hashed):
                continue
            place = np.searchsorted(known, hashed)
            place[place == len(known)] = 0
            for at in np.flatnonzero(known[place] == hashed):
                owners = self.windows.get(tuple(codes[at:at + size].tolist()))
                if owners:
                    edges[at] += 1
                    edges[at + size] -= 1
                    items.update(self.names[owner] for owner in owners)
        return np.cumsum(edges[:-1]) > 0, items


def blocks_of(benchmark: DataFrame, item_id: str, text: str) -> Iterator[Block]:
    """The benchmark's items, streamed to the driver one block at a time."""
    rows = benchmark.select(
        F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"),
        F.col(text).cast("binary").alias("data"),
    )
    held, windows = [], 0
    for row in rows.toLocalIterator():
        words = words_of(row.data and bytes(row.data))
        count = max(1, len(words) - WINDOW + 1)
        if held and windows + count > BLOCK_WINDOWS:
            yield Block(held)
            held, windows = [], 0
        if words:
            held.append((row.item, words))
            windows += count
    yield Block(held)


def scan(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``hit`` (a byte per word, 1 inside a benchmark window) and ``items``."""
    spark = docs.sparkSession
    ship_package(spark)
    out, first = docs, True
    for block in blocks_of(benchmark, item_id, "text"):
        if not first:
            out = stage(out, "decontaminate")
        out = _scan_block(out, spark.sparkContext.broadcast(block), text, first)
        first = False
    return out


def _scan_block(docs: DataFrame, shared, text: str, first: bool) -> DataFrame:
    def make():
        block: Block = shared.value

        def compute(part: pa.RecordBatch) -> list:
            counts, hits, found = [], [], []
            before = None if first else (part.column("hit").to_pylist(), part.column("items").to_pylist())
            for at, data in enumerate(part.column(text).cast(pa.binary()).to_pylist()):
                words = words_of(data)
                hit, items = block.scan(words)
                if before:
                    hit = hit | (np.frombuffer(before[0][at], np.uint8) > 0)
                    items = items.union(before[1][at])
                counts.append(len(words))
                hits.append(hit.astype(np.uint8).tobytes() if len(words) else b"")
                found.append(sorted(items))
            totals = [hit.count(1) for hit in hits]
            return [
                pa.array(counts, pa.int64()), pa.array(totals, pa.int64()), pa.array(hits, pa.binary()),
                pa.array(found, pa.list_(pa.string())),
            ]

        return compute

    if first:
        return arrow_pass(docs, "n_words bigint, n_hit bigint, hit binary, items array<string>", make)
    marks = ["n_words", "n_hit", "hit", "items"]
    passed = arrow_pass(
        docs.drop("n_words", "n_hit"), "n_words bigint, n_hit bigint, new_hit binary, new_items array<string>", make
    )
    return passed.drop("hit", "items").withColumnsRenamed({"new_hit": "hit", "new_items": "items"}).select(
        *[c for c in docs.columns if c not in marks], *marks
    )


def summary(scanned: DataFrame) -> DataFrame:
    """Per document the counts, the items' ids as a hash, and ``contaminated``."""
    return scanned.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without any benchmark window, with their own columns only."""
    names = {name: f"c{place}" for place, name in enumerate(docs.columns)}
    scanned = scan(docs.toDF(*names.values()), benchmark, names[text])
    return scanned.where("n_hit = 0").select(*[F.col(short).alias(name) for name, short in names.items()])
