"""Operator 11: packing token sequences into windows by minimum bin slack.

Documents are encoded and cut into segments: whole windows, and what remains of
each document, shorter than a window. How many segments have each length is a
histogram with one entry per length, which does not grow with the corpus; the
windows are planned on it. A window starts with the longest length left, and a
subset-sum over the lengths that fit, kept as the bits of one integer per step
(each length as often as segments of it are left, in powers of two), finds the
multiset that comes closest to the capacity; going back over the steps gives
how often each length is taken. The multiset found is used for as many windows
as the histogram has segments for. Where no multiset fills a window, the longest
segment left gives its first tokens to the slack and stays with the rest, so
every window but those of the last tokens is full. The last tokens, fewer than
a window, are cut into sequences whose lengths are powers of two, the largest
first, so nothing is padded.

A plan is a list of intervals: the segments of a length with ranks from a to b
go, from a token on and so many per window, to the windows from w on. It has some
rows per length, whatever the corpus, and is broadcast. A segment's rank is its
number among the equal ones of its file part, counted as it was written, plus
those in the parts before, so equal lengths (a third of all rows may have one)
never meet in a task. Token ids are read again for segments that are cut.

Defined results: null and empty texts are the end id alone; repeated rows and ids
are packed each for itself; null ids stay null; an empty table gives no rows;
extra columns, whatever their names, are left out.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbwise.llm.batches import ship_package, slices_by_size, stage
from curbwise.llm.library import SLICE_BYTES, encoder, gather

CAPACITY, END_ID = 4096, 2
_SEGMENT = "doc_id bigint, doc_tokens bigint, start bigint, length int, part int, rank bigint, ids_crc32 bigint, ids array<int>"


def cumulative_counts(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each value among its equals, going on from ``seen``, which is brought up to date."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    many = np.diff(np.append(first, len(ordered)))
    ranks = np.empty(len(values), np.int64)
    ranks[order] = np.arange(len(values)) - np.repeat(first, many) + seen[ordered]
    seen[ordered[first]] += many
    return ranks


def crc_of(flat: np.ndarray, offsets: np.ndarray) -> list[int]:
    data = memoryview(flat.astype("<u4", copy=False)).cast("B")
    ends = (4 * offsets).tolist()
    return [zlib.crc32(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def segments(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: tuple[int, ...] = (END_ID,),
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The encoded documents in segments of at most ``capacity`` ids, written and read back.

    ``part`` and ``rank`` name a segment together with its length: the task that
    wrote it, and its number among that task's segments of the same length.
    """
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches):
        library, part, seen = None, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices_by_size(batches, "text", SLICE_BYTES):
            library = library or encoder(shared.value)
            encoded = library.encode_all(batch.column("text"), list(end))
            flat, bounds = encoded.values.to_numpy(), encoded.offsets.to_numpy().astype(np.int64)
            tokens = np.diff(bounds)
            many = -(-tokens // capacity)
            owner = np.repeat(np.arange(len(tokens)), many)
            start = capacity * (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many))
            length = np.minimum(tokens[owner] - start, capacity)
            offsets = np.append(bounds[owner] + start, len(flat))
            n = len(owner)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(owner)), pa.array(tokens[owner]), pa.array(start),
                pa.array(length.astype(np.int32)), pa.array(np.full(n, part, np.int32)),
                pa.array(cumulative_counts(length, seen)), pa.array(crc_of(flat, offsets), pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), encoded.values),
            ], ["doc_id", "doc_tokens", "start", "length", "part", "rank", "ids_crc32", "ids"])

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return stage(narrow.mapInArrow(run, _SEGMENT), "packing-segments")


def closest_fill(room: int, left: dict[int, int], lengths: list[int]) -> tuple[int, dict[int, int]]:
    """The slack and the multiset of ``lengths`` (descending, each at most ``left`` times) that comes closest to ``room``."""
    sums, mask, steps = 1, (2 << room) - 1, []
    for length in lengths:
        if length > room or sums >> room:
            continue
        most, copies = min(left[length], room // length), 1
        while most > 0 and not sums >> room:
            copies = min(copies, most)
            steps.append((length, copies, sums))
            sums |= sums << (length * copies) & mask
            most, copies = most - copies, 2 * copies
    total = sums.bit_length() - 1
    slack, used = room - total, {}
    for length, copies, before in reversed(steps):
        if not before >> total & 1:
            total -= length * copies
            used[length] = used.get(length, 0) + copies
    return slack, used


class Plan:
    """Where the segments go, by length and rank.

    ``rows`` has (length, first rank, end rank, from, tokens, window, per window, offset,
    phase): the segments of these ranks give ``tokens`` ids counted ``from`` their start
    to windows from ``window`` on; number ``phase`` of the row of segments is the first.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY) -> None:
        self.rows: list[tuple[int, ...]] = []
        self.windows = 0
        self.left: dict[int, int] = defaultdict(int)
        #: Per length left: runs (length at first, first rank, how many, tokens already given).
        self.runs: dict[int, deque[tuple[int, int, int, int]]] = defaultdict(deque)
        for length, many in counts.items():
            self.put(length, (length, 0, many, 0))
        while self.left:
            self.fill(capacity)

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.runs[length].append(run)
        self.left[length] += run[2]

    def take(self, length: int, many: int) -> list[tuple[int, int, int, int]]:
        taken, queue = [], self.runs[length]
        self.left[length] -= many
        if not self.left[length]:
            del self.left[length]
        while many:
            first, rank, n, given = queue.popleft()
            if n > many:
                queue.appendleft((first, rank + many, n - many, given))
                n = many
            taken.append((first, rank, n, given))
            many -= n
        return taken

    def place(self, runs: list[tuple[int, int, int, int]], tokens: int, per_window: int, offset: int) -> None:
        phase = 0
        for first, rank, n, given in runs:
            self.rows.append((first, rank, rank + n, given, tokens, self.windows, per_window, offset, phase))
            phase += n

    def fill(self, capacity: int) -> None:
        """Plan the windows of one multiset."""
        lengths = sorted(self.left, reverse=True)
        seed = lengths[0]
        self.left[seed] -= 1
        slack, used = closest_fill(capacity - seed, self.left, lengths)
        self.left[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        donor = next((each for each in lengths if self.left[each] > used.get(each, 0)), None) if slack else None
        if slack and donor is None:
            return self.finish(used)
        needed = used | ({donor: used.get(donor, 0) + 1} if slack else {})
        windows = min(self.left[length] // many for length, many in needed.items())
        offset = 0
        for length, many in sorted(used.items(), reverse=True):
            self.place(self.take(length, many * windows), length, many, offset)
            offset += length * many
        if slack:
            given = self.take(donor, windows)
            self.place(given, slack, 1, offset)
            for first, rank, n, before in given:
                self.put(donor - slack, (first, rank, n, before + slack))
        self.windows += windows
        return None

    def finish(self, used: dict[int, int]) -> None:
        """The last tokens: sequences of powers of two."""
        total = sum(length * many for length, many in used.items())
        size, offset = 1 << total.bit_length() - 1, 0
        for length, many in sorted(used.items(), reverse=True):
            for first, rank, n, given in self.take(length, many):
                for each in range(rank, rank + n):
                    at = 0
                    while at < length:
                        tokens = min(length - at, size - offset)
                        self.rows.append((first, each, each + 1, given + at, tokens, self.windows, 1, offset, 0))
                        at, offset, total = at + tokens, offset + tokens, total - tokens
                        if offset == size:
                            self.windows, size, offset = self.windows + 1, 1 << max(total.bit_length() - 1, 0), 0


class Lookup:
    """A plan as arrays: the rows that hold for each interval of ranks of a length."""

    def __init__(self, rows: list[tuple[int, ...]]) -> None:
        by_length = defaultdict(list)
        for number, row in enumerate(rows):
            by_length[row[0]].append((row[1], row[2], row[3], number))
        keys, first, many, items = [], [], [], []
        for length in sorted(by_length):
            intervals = by_length[length]
            starting, ending = defaultdict(list), defaultdict(list)
            for a, b, given, number in intervals:
                starting[a].append((given, number))
                ending[b].append((given, number))
            open_: set[tuple[int, int]] = set()
            for bound in sorted({*starting, *ending}):
                open_.difference_update(ending.get(bound, ()))
                open_.update(starting.get(bound, ()))
                keys.append((length << 48) + bound)
                first.append(len(items))
                many.append(len(open_))
                items += [number for _, number in sorted(open_)]
        self.rows = np.array(rows, np.int64).reshape(-1, 9)
        self.keys, self.first, self.many, self.items = (np.array(each, np.int64) for each in (keys, first, many, items))

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each segment its pieces: how many, and of each (from, tokens, sequence, offset)."""
        at = np.searchsorted(self.keys, (length.astype(np.int64) << 48) + rank, side="right") - 1
        found, many = gather(self.items, self.first, self.many, at)
        _, a, _, given, tokens, window, per_window, offset, phase = self.rows[found].T
        number = np.repeat(rank, many) - a + phase
        return many, given, tokens, window + number // per_window, offset + number % per_window * tokens


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Every segment of ``parts`` without its ids, and its pieces in order: (from, tokens, sequence_id, offset)."""
    spark = parts.sparkSession
    counts = stage(parts.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "packing-counts")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # a row per length at most
    shared = spark.sparkContext.broadcast(Lookup(Plan({row["length"]: row["n"] for row in totals}, capacity).rows))
    before = F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")
    narrow = parts.drop("ids").join(counts.select("part", "length", before.alias("before")), ["part", "length"])
    names = ["part", "length", "rank", "doc_id", "doc_tokens", "start", "ids_crc32"]

    def run(batches):
        lookup = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            overall = batch.column("before").to_numpy() + batch.column("rank").to_numpy()
            many, *columns = lookup.find(batch.column("length").to_numpy(), overall)
            pieces = pa.StructArray.from_arrays([pa.array(each) for each in columns], ["from", "tokens", "sequence_id", "offset"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(offsets, pieces)], [*names, "pieces"])

    return narrow.select(*names, "before").mapInArrow(
        run, "part int, length int, rank bigint, doc_id bigint, doc_tokens bigint, start bigint, ids_crc32 bigint, "
        "pieces array<struct<from:bigint,tokens:bigint,sequence_id:bigint,offset:bigint>>"
    )


def pieces(parts: DataFrame, placed: DataFrame) -> DataFrame:
    """A row per piece, without its ids; a piece that is a whole segment has that segment's checksum."""
    placed = stage(placed, "packing-placed")
    columns = ["doc_id", (F.col("start") + F.col("piece.from")).alias("start"), F.col("piece.tokens").alias("length")]
    rest = ["doc_tokens", "piece.sequence_id", "piece.offset"]
    whole = placed.where(F.size("pieces") == 1).withColumn("piece", F.col("pieces")[0])
    whole = whole.select(*columns, "ids_crc32", *rest)
    cut = placed.where(F.size("pieces") > 1).drop("ids_crc32")
    cut = parts.select("part", "length", "rank", "ids").join(cut, ["part", "length", "rank"])
    cut = cut.withColumn("piece", F.explode("pieces")).withColumn(
        "ids", F.slice("ids", (F.col("piece.from") + 1).cast("int"), F.col("piece.tokens").cast("int"))
    )

    def sums(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy().astype(np.int64)
            kept = [name for name in batch.schema.names if name != "ids"]
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept), pa.array(crc_of(flat, offsets), pa.int64())], [*kept, "ids_crc32"]
            )

    plain = cut.select(*columns, *rest, "ids")
    summed = plain.mapInArrow(
        sums, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids_crc32 bigint"
    )
    return whole.unionByName(summed)


def sequences(parts: DataFrame, placed: DataFrame, capacity: int = CAPACITY, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, documents): the packed ids, padded to the capacity or not at all at a power of two.

    ``documents`` has (doc_id, start, length, offset) of the pieces. A sequence has
    ``capacity`` ids at most, so no group is larger.
    """
    joined = parts.select("part", "length", "rank", "ids").join(
        placed.select("part", "length", "rank", "doc_id", "start", F.explode("pieces").alias("piece")), ["part", "length", "rank"]
    )
    piece = F.struct(
        F.col("piece.offset").alias("offset"), "doc_id", (F.col("start") + F.col("piece.from")).alias("start"),
        F.slice("ids", (F.col("piece.from") + 1).cast("int"), F.col("piece.tokens").cast("int")).alias("ids"),
    )
    grouped = joined.groupBy(F.col("piece.sequence_id").alias("sequence_id")).agg(F.sort_array(F.collect_list(piece)).alias("all"))
    ids = F.flatten(F.transform("all", lambda each: each["ids"]))
    size = F.size(ids)
    missing = F.when(size.bitwiseAND(size - 1) == 0, 0).otherwise(capacity - size)
    documents = F.transform("all", lambda each: F.struct(
        each["doc_id"], each["start"], F.size(each["ids"]).alias("length"), each["offset"]
    ))
    return grouped.select(
        "sequence_id", F.concat(ids, F.array_repeat(F.lit(pad), missing)).alias("ids"), documents.alias("documents")
    )
