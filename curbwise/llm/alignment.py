"""Operator 12: aligning two tokenizers, and counting which of their tokens end together.

A text is encoded with a byte-level vocabulary (A) and a piece vocabulary (B).
Where tokens of both end at the same byte, the text is cut into groups, and the
two tokens that end there are linked. How often a pair of ids is linked in the
whole corpus is counted by external spilling:

1. Each slice of texts becomes a run. Its (pair, document, times) records are
   radix-partitioned by the B id, sorted by B id, A id and document, and spilled
   as zstd blocks: pairs with their sums apart from the documents.
2. Runs of a partition are merged by a heap, ``FAN`` at a time, into runs of pairs
   and sums, and these again until one run is left. It comes in the order of the
   B ids, so the largest count of each is known when its pairs end.
3. The counts stream back the same way down: each merged run gives its own runs
   the counts of their pairs, and the first runs turn them into what each of
   their documents gets from the partition.

Groups of Spark are (partition, merged run) with some ``FAN`` blocks, or one run, so a
frequent pair or token is never one task's; lost work is done again from the
staged blocks. No pair of the corpus is dropped.

Between a character that is no space and a space before a character that is no white space both
tokenizers start anew, and so they do between plain letters, marks and a line
feed (checked on the vocabularies when they are read). So stretches between
spaces are encoded once for each worker and put together by Arrow and numpy.

Defined results: null and empty texts and texts whose bytes either tokenizer does
not give back (U+2581) have no tokens, zeros and empty groups; repeated rows
count each for itself; null ids stay null; an empty table gives no rows; extra
columns, whatever their names, are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import math
import os
import re
from collections.abc import Iterable, Iterator
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import ship_package, slices_by_size, stage
from curbwise.llm.bpe import byte_symbols
from curbwise.llm.library import PLAIN, IntLists, gather, split_words

#: Bytes of text in a run, units a worker remembers, units in one call of the piece library; only speed depends on them.
RUN_BYTES, KEPT_UNITS, PIECE_CALL = 8 << 20, 600_000, 400
#: Runs merged at a time, and radix partitions (a power of two).
FAN, RADIX = 64, 32
_RADIX_BITS, _ID_BITS = RADIX.bit_length() - 1, 20
_DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
_CUT = re.compile(r"(?<! ) (?=\S)")


def pair_code(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One integer for a pair: its radix partition, the rest of the B id, the A id."""
    low = b & (RADIX - 1)
    return (low << (2 * _ID_BITS - _RADIX_BITS)) | ((b >> _RADIX_BITS) << _ID_BITS) | a


def radix_of(pairs: np.ndarray) -> np.ndarray:
    return pairs >> (2 * _ID_BITS - _RADIX_BITS)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as one zstd block, equal bytes of the numbers together."""
    parts = [np.array([len(each) for each in arrays], "<i8").tobytes()]
    parts += [np.ascontiguousarray(each.astype("<i8")).view(np.uint8).reshape(-1, 8).T.tobytes() for each in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes, many: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    sizes, at, arrays = raw[:8 * many].view("<i8").tolist(), 8 * many, []
    for size in sizes:
        arrays.append(np.ascontiguousarray(raw[at:at + 8 * size].reshape(8, size).T).view("<i8").ravel())
        at += 8 * size
    return arrays


def pack_pairs(pairs: np.ndarray, *columns: np.ndarray) -> bytes:
    return pack(np.diff(pairs, prepend=0), *columns)


def unpack_pairs(data: bytes, columns: int = 1) -> list[np.ndarray]:
    steps, *rest = unpack(data, columns + 1)
    return [np.cumsum(steps), *rest]


class Aligner:
    """Both tokenizers behind a table of the units already aligned.

    A unit is a word with the space before it, a word without, marks, or a
    whole stretch that is none of these.
    """

    def __init__(self, byte_level: bytes, pieces: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        spec = json.loads(byte_level)
        before = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space"):
            raise ValueError("the first vocabulary must be byte-level, with its pattern and without a normaliser")
        # One reads special tokens in a text as text, the other as marks between units.
        self.a, self.a_marked = (Tokenizer.from_str(byte_level.decode("utf-8")) for _ in range(2))
        self.a.encode_special_tokens = True
        self.specials = [token.content for token in self.a.get_added_tokens_decoder().values()]
        self.a_mark = self.a.token_to_id(self.specials[-1])
        self.a_bytes = np.zeros(self.a.get_vocab_size(), np.int64)
        symbols = set(byte_symbols())
        for token, number in self.a.get_vocab().items():
            self.a_bytes[number] = len(token) if symbols.issuperset(token) else len(token.encode())

        self.b = SentencePieceProcessor(model_proto=pieces)
        names = [self.b.id_to_piece(number) for number in range(self.b.get_piece_size())]
        byte = [self.b.is_byte(number) for number in range(len(names))]
        self.b_bytes = np.array([
            1 if single else len(name.replace("▁", " ").encode()) for name, single in zip(names, byte, strict=True)
        ], np.int64)
        spelled = [name for name, single in zip(names, byte, strict=True) if not single]
        # A control character that no longer piece has is a token of its own, wherever it stands.
        free = [chr(code) for code in range(1, 9) if not any(chr(code) in name and len(name) > 1 for name in spelled)]
        if not free or not any(byte) or any(re.search("[^▁]▁", name) for name in spelled):
            raise ValueError("the second vocabulary must have byte pieces, and no piece across a space")
        self.mark = free[0]
        self.b_mark = self.b.encode(self.mark)[-1]
        # Pieces with both letters and marks would join a word and the marks after it.
        mixed = any(re.search(f"[{PLAIN}]", name) and re.search("[.,\n]", name) for name in spelled)
        self.word = "$^" if mixed else f"^[{PLAIN}]+[.,]*$"
        self.two_lines = "$^" if mixed else f"^[{PLAIN}]+[.,]*\n[{PLAIN}]+[.,]*$"
        self.clear()

    def clear(self) -> None:
        # Row 0 is the missing unit.
        self.known: dict[str, int] = {}
        self.links = IntLists(np.int64)
        self.links.append(np.empty(0, np.int64), np.zeros(1, np.int64))
        self.many = np.zeros((1, 2), np.int64)
        self.good = np.ones(1, bool)
        self.spelled = pa.array([None], pa.string())

    def encode_a(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        joined = self.specials[-1].join(units)
        if sum(map(joined.count, self.specials)) >= len(units):
            found = [each.ids for each in self.a.encode_batch_fast(units, add_special_tokens=False)]
            sizes = np.array([len(each) for each in found], np.int64)
            return np.array([number for each in found for number in each], np.int64), sizes
        ids = np.array(self.a_marked.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        marks = ids == self.a_mark
        return ids[~marks], np.diff(np.append(np.flatnonzero(marks), len(ids)), prepend=-1) - 1

    def encode_b(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat, sizes = [], []
        plain = [unit for unit in units if self.mark not in unit]
        calls = [plain[at:at + PIECE_CALL] for at in range(0, len(plain), PIECE_CALL)]
        # What stands before the first mark is the space that the library puts in front.
        for call, ids in zip(calls, self.b.encode([self.mark + self.mark.join(call) for call in calls], num_threads=1), strict=True):
            ids = np.array(ids, np.int64)
            marks = np.flatnonzero(ids == self.b_mark)
            flat.append(np.delete(ids[marks[0]:], marks - marks[0]))
            sizes.append(np.diff(np.append(marks, len(ids))) - 1)
        ids = np.concatenate([*flat, np.empty(0, np.int64)])
        many = np.concatenate([*sizes, np.empty(0, np.int64)])
        if len(plain) == len(units):
            return ids, many
        each = iter(np.split(ids, np.cumsum(many)[:-1]))
        found = [
            np.array(self.b.encode(self.mark + unit, num_threads=1)[2:], np.int64) if self.mark in unit else next(each)
            for unit in units
        ]
        return np.concatenate(found), np.array([len(each) for each in found], np.int64)

    def learn(self, units: list[str]) -> None:
        """Align units not met before."""
        a, many_a = self.encode_a(units)
        b, many_b = self.encode_b(units)
        size = np.array([len(unit.encode()) for unit in units], np.int64)
        total = [
            np.add.reduceat(np.append(each, 0), np.cumsum(many) - many) * (many > 0)
            for each, many in ((self.a_bytes[a], many_a), (self.b_bytes[b], many_b))
        ]
        good = (total[0] == size) & (total[1] == size) & np.array(["▁" not in unit for unit in units])
        a, b = a[np.repeat(good, many_a)], b[np.repeat(good, many_b)]
        many_a, many_b = many_a * good, many_b * good
        # Over all good units together: the bytes are the same, and units end where tokens of both end.
        end_a, end_b = np.cumsum(self.a_bytes[a]), np.cumsum(self.b_bytes[b])
        ends = np.intersect1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        groups = np.diff(np.searchsorted(ends, np.cumsum(size * good), side="right"), prepend=0)
        sides = [
            pc.binary_join(pa.ListArray.from_arrays(
                pa.array(np.append(0, at + 1).astype(np.int32)), pa.array(ids).cast(pa.string())
            ), ",") for ids, at in ((a, at_a), (b, at_b))
        ]
        written = pc.binary_join_element_wise(*sides, "|")
        written = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(groups)).astype(np.int32)), written), ";")
        written = pc.if_else(pa.array(groups > 0), written, pa.scalar(None, pa.string()))
        self.known.update(zip(units, range(len(self.good), len(self.good) + len(units)), strict=True))
        self.links.append(pair_code(a[at_a], b[at_b]), groups)
        self.many = np.concatenate([self.many, np.stack([many_a, many_b], axis=1)])
        self.good = np.append(self.good, good)
        self.spelled = pa.concat_arrays([self.spelled, written])

    def rows(self, units: pa.Array) -> np.ndarray:
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = [unit for unit in distinct if unit not in self.known and unit != ""]
        if new:
            self.learn(new)
        found = np.array([self.known.get(unit, 0) for unit in distinct], np.int64)
        return found[coded.indices.to_numpy()]

    def units_of(self, distinct: pa.Array) -> np.ndarray:
        """Rows of the units of stretches, four at most for each; a stretch stands for itself with a space before it."""
        units = np.zeros((len(distinct), 4), np.int64)
        word = pc.match_substring_regex(distinct, self.word)
        lines = pc.match_substring_regex(distinct, self.two_lines)

        def parts(words: pa.Array, before: str, after: str) -> tuple[np.ndarray, np.ndarray]:
            stems = pc.binary_join_element_wise(before, pc.utf8_rtrim(words, characters=".,"), "")
            marks = pc.binary_join_element_wise(pc.utf8_ltrim(words, characters=PLAIN), after, "")
            return self.rows(stems), self.rows(marks)

        where = word.to_numpy(zero_copy_only=False)
        units[where, 0], units[where, 1] = parts(distinct.filter(word), " ", "")
        where = lines.to_numpy(zero_copy_only=False)
        if where.any():
            halves = pc.split_pattern(distinct.filter(lines), pattern="\n").flatten()
            even = pa.array(np.arange(len(halves)) % 2 == 0)
            units[where, 0], units[where, 1] = parts(halves.filter(even), " ", "\n")
            units[where, 2], units[where, 3] = parts(halves.filter(pc.invert(even)), "", "")
        other = pc.invert(pc.or_(word, lines))
        units[other.to_numpy(zero_copy_only=False), 0] = self.rows(pc.binary_join_element_wise(" ", distinct.filter(other), ""))
        return units

    def align(self, distinct: pa.Array, codes: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Of texts given as stretches: (n_a, n_b, links) of each, its groups, all links, and which texts are good."""
        if len(self.known) >= KEPT_UNITS:
            self.clear()
        units = self.units_of(distinct)
        pairs, sizes = self.links.gather(units.ravel())
        sizes = sizes.reshape(-1, 4).sum(axis=1)
        counts = np.column_stack([self.many[units].sum(axis=1), sizes, ~self.good[units].all(axis=1)])
        # The first unit is there wherever the stretch is good; skipping nothing but nulls would lose the row.
        first, *others = (self.spelled.take(pa.array(np.ascontiguousarray(units[:, column]))) for column in range(4))
        written = pc.binary_join_element_wise(pc.fill_null(first, ""), *others, ";", null_handling="skip")
        cut = np.cumsum(many) - many
        per_text = np.add.reduceat(counts[codes], cut) if len(many) else np.zeros((0, 4), np.int64)
        good = per_text[:, 3] == 0
        codes = codes[np.repeat(good, many)]
        many = many * good
        found, _ = gather(pairs, np.cumsum(sizes) - sizes, sizes, codes)
        texts = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(many)).astype(np.int32)), written.take(pa.array(codes)))
        return per_text[:, :3] * good[:, None], pc.binary_join(texts, ";"), found, good

    def texts(self, values: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """(n_a, n_b, links) of each text, its groups (null: it has no tokens), and all links in the order of the texts."""
        values = pc.fill_null(values, "")
        distinct, codes, many = split_words(values)
        # Where white space follows a space the stretch before it is longer; such texts are cut apart one by one.
        odd = pc.or_(pc.equal(distinct, ""), pc.utf8_is_space(pc.utf8_slice_codeunits(distinct, 0, 1)))
        odd = odd.to_numpy(zero_copy_only=False)[codes]
        plain = ~np.logical_or.reduceat(odd, np.cumsum(many) - many) if len(many) else np.zeros(0, bool)
        counts, written, links, good = self.align(distinct, codes[np.repeat(plain, many)], many[plain])
        sure = np.zeros(len(values), bool)
        sure[plain] = good
        order = [np.flatnonzero(plain)]
        rest = np.flatnonzero(~plain & (pc.binary_length(values).to_numpy(zero_copy_only=False) > 0))
        if len(rest):
            rows = []
            for value in values.take(pa.array(rest)).to_pylist():
                first, *others = _CUT.split(" " + value)
                rows.append(others if first == "" else [first[1:], *others])
            coded = pa.array([stretch for row in rows for stretch in row], pa.string()).dictionary_encode()
            more = self.align(
                coded.dictionary, coded.indices.to_numpy(), np.array([len(row) for row in rows], np.int64)
            )
            sure[rest] = more[3]
            counts, links = np.concatenate([counts, more[0]]), np.concatenate([links, more[2]])
            written = pa.concat_arrays([written, more[1]])
            order.append(rest)
        # Back into the order of the texts.
        place = np.concatenate(order)
        full = np.zeros((len(values), 3), np.int64)
        full[place] = counts
        back = np.full(len(values), -1, np.int64)
        back[place] = np.arange(len(place))
        starts = np.zeros(len(place) + 1, np.int64)
        np.cumsum(counts[:, 2], out=starts[1:])
        links, _ = gather(links, starts[:-1], counts[:, 2], back[back >= 0])
        return full, written.take(pa.array(back, mask=~sure)), links


def spill(links: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix partitions of a run: sorted pairs with their sums, and the documents of each pair with their times."""
    keys = np.sort((links << _ID_BITS) | owner)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    times = np.diff(np.append(first, len(keys)))
    pairs, docs = keys[first] >> _ID_BITS, keys[first] & ((1 << _ID_BITS) - 1)
    new = np.flatnonzero(np.diff(pairs, prepend=-1))
    distinct, sums = pairs[new], np.add.reduceat(times, new) if len(new) else new
    per_pair = np.diff(np.append(new, len(pairs)))
    cuts = np.searchsorted(radix_of(distinct), np.arange(RADIX + 1))
    bounds = np.append(new, len(pairs))
    for radix, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if a < b:
            here = slice(bounds[a], bounds[b])
            yield radix, pack_pairs(distinct[a:b], sums[a:b]), pack(per_pair[a:b], docs[here], times[here])


_aligners: dict[int, Aligner] = {}


def runs(docs: DataFrame, byte_level: str, pieces: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(run, docs, records): the documents of each run, and its spilled partitions."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast((Path(byte_level).read_bytes(), Path(pieces).read_bytes()))
    doc = pa.list_(pa.struct([
        ("doc_id", pa.int64()), *[(name, pa.int64()) for name in ("n_a", "n_b", "n_links")], ("groups_sha256", pa.string()),
    ]))
    record = pa.list_(pa.struct([("radix", pa.int32()), ("pairs", pa.binary()), ("documents", pa.binary())]))

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in slices_by_size(batches, "text", RUN_BYTES):
            key = hash(shared.value)
            if key not in _aligners:
                _aligners[key] = Aligner(*shared.value)
            counts, groups, links = _aligners[key].texts(batch.column("text"))
            owner = np.repeat(np.arange(len(counts)), counts[:, 2])
            hashes = ["" if each is None else hashlib.sha256(each.encode()).hexdigest() for each in groups.to_pylist()]
            rows = pa.StructArray.from_arrays(
                [batch.column("doc_id"), *[pa.array(np.ascontiguousarray(each)) for each in counts.T], pa.array(hashes)],
                [field.name for field in doc.value_type],
            )
            spilled = [dict(zip(("radix", "pairs", "documents"), each, strict=True)) for each in spill(links, owner)]
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows),
                pa.array([spilled], record),
            ], ["run", "docs", "records"])
            number += 1

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return stage(narrow.mapInArrow(
        run, "run bigint, docs array<struct<doc_id:bigint,n_a:bigint,n_b:bigint,n_links:bigint,groups_sha256:string>>, "
        "records array<struct<radix:int,pairs:binary,documents:binary>>"
    ), "alignment-runs")


def merged(blocks: Iterable[bytes]) -> Iterator[tuple[int, int]]:
    """Pairs in order with the sum of their counts, by a heap over sorted runs."""
    streams = (zip(*(each.tolist() for each in unpack_pairs(block)), strict=True) for block in blocks)
    for pair, rows in groupby(heapq.merge(*streams), key=lambda row: row[0]):
        yield pair, sum(count for _, count in rows)


def merge_blocks(table: pa.Table) -> pa.Table:
    """The runs of one group as one run."""
    rows = list(merged(table.column("pairs").to_pylist()))
    pairs, counts = np.array(rows, np.int64).reshape(-1, 2).T
    return pa.table({
        "radix": table.column("radix").slice(0, 1), "node": table.column("parent").slice(0, 1),
        "pairs": pa.array([pack_pairs(pairs, counts)], pa.binary()),
    })


def with_maxima(table: pa.Table) -> pa.Table:
    """The last run of a partition, with the largest count of each B id marked as its pairs end."""
    block = table.column("pairs")[0].as_py()
    pairs, counts = unpack_pairs(block)
    side = pairs >> _ID_BITS
    start = np.flatnonzero(np.diff(side, prepend=-1))
    most = np.repeat(np.maximum.reduceat(counts, start), np.diff(np.append(start, len(side))))
    return table.set_column(
        table.schema.get_field_index("pairs"), "pairs",
        pa.array([pack_pairs(pairs, counts, (counts == most).astype(np.int64))], pa.binary()),
    ).select(["radix", "node", "pairs"])


def hand_down(children: pa.Table, parent: pa.Table) -> pa.Table:
    """The counts of the merged run for the pairs of each of its runs."""
    pairs, counts, best = unpack_pairs(parent.column("pairs")[0].as_py(), 2)
    blocks = []
    for block in children.column("pairs").to_pylist():
        own = unpack_pairs(block)[0]
        at = np.searchsorted(pairs, own)
        blocks.append(pack_pairs(own, counts[at], best[at]))
    return pa.table({
        "radix": children.column("radix"), "node": children.column("node"), "pairs": pa.array(blocks, pa.binary()),
    })


def contribute(children: pa.Table, parent: pa.Table) -> pa.Table:
    """What each document of the runs gets from a partition: links that are best, and the sum of their counts."""
    pairs, counts, best = unpack_pairs(parent.column("pairs")[0].as_py(), 2)
    blocks = []
    for block, documents in zip(children.column("pairs").to_pylist(), children.column("documents").to_pylist(), strict=True):
        at = np.searchsorted(pairs, unpack_pairs(block)[0])
        per_pair, docs, times = unpack(documents, 3)
        at = np.repeat(at, per_pair)
        sums = np.zeros((2, int(docs.max()) + 1), np.int64)
        np.add.at(sums[0], docs, times * best[at])
        np.add.at(sums[1], docs, times * counts[at])
        blocks.append(pack(*sums))
    return pa.table({"run": children.column("node"), "sums": pa.array(blocks, pa.binary())})


def finished(sums: pa.Table, run: pa.Table) -> pa.Table:
    """The documents of a run with what all partitions gave them."""
    rows = run.column("docs").combine_chunks().flatten()
    total = np.zeros((2, len(rows)), np.int64)
    for block in sums.column("sums").to_pylist():
        best, counts = unpack(block, 2)
        total[0, :len(best)] += best
        total[1, :len(counts)] += counts
    field = {each.name: rows.field(each.name) for each in rows.type}
    return pa.table({
        "doc_id": field["doc_id"], "n_a": field["n_a"], "n_b": field["n_b"], "n_groups": field["n_links"],
        "n_links": field["n_links"], "n_best": pa.array(total[0]), "count_sum": pa.array(total[1]),
        "groups_sha256": field["groups_sha256"],
    })


def summary(spilled: DataFrame, fan: int = FAN) -> DataFrame:
    """A row per document of the runs, with the corpus-wide counts of its links."""
    nodes = spilled.select(F.col("run").alias("node"), F.inline("records"))
    many, levels = max(spilled.count(), 1), []
    block = "radix int, node bigint, pairs binary"
    while True:
        many = math.ceil(many / fan)
        nodes = nodes.withColumn("parent", F.pmod(F.xxhash64("node"), F.lit(many)))
        levels.append(nodes)
        nodes = stage(
            nodes.select("radix", "parent", "pairs").groupBy("radix", "parent").applyInArrow(merge_blocks, block), "alignment-merged"
        )
        if many == 1:
            break
    counts = stage(nodes.groupBy("radix").applyInArrow(with_maxima, block), "alignment-counts")
    for nodes in levels[:0:-1]:
        below = nodes.select("radix", "parent", "node", "pairs").groupBy("radix", "parent")
        counts = counts.withColumnRenamed("node", "parent").groupBy("radix", "parent")
        counts = stage(below.cogroup(counts).applyInArrow(hand_down, block), "alignment-counts")
    counts = counts.withColumnRenamed("node", "parent").groupBy("radix", "parent")
    given = stage(levels[0].groupBy("radix", "parent").cogroup(counts).applyInArrow(contribute, "run bigint, sums binary"), "alignment-sums")
    return given.groupBy("run").cogroup(spilled.select("run", "docs").groupBy("run")).applyInArrow(finished, _DOC)


def pair_counts(spilled: DataFrame) -> DataFrame:
    """(a, b, count) of every linked pair of the corpus, from the spilled runs."""
    def rows(batches):
        for batch in batches:
            for block in batch.column("pairs").to_pylist():
                pairs, counts = unpack_pairs(block)
                b = ((pairs >> _ID_BITS) % (1 << (_ID_BITS - _RADIX_BITS)) << _RADIX_BITS) | radix_of(pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs & ((1 << _ID_BITS) - 1)), pa.array(b), pa.array(counts)], ["a", "b", "count"]
                )

    blocks = spilled.select(F.inline("records")).select("pairs")
    return blocks.mapInArrow(rows, "a bigint, b bigint, count bigint").groupBy("a", "b").agg(F.sum("count").alias("count"))
