"""Operator 1: byte-pair encoding and decoding with a contiguous rank array per word.

A word is held as one string plus two flat lists: the boundaries of its parts
and the merge ranks of adjacent parts. The loop scans the ranks for the
smallest (the leftmost of equals), deletes that boundary and refreshes the two
ranks beside it. Words are short, so the scan stays within a cache line or two;
a word beyond ``LONG_WORD`` symbols would make the scan quadratic, so its
merges come from a heap in the same order and give the same parts.

The vocabulary file is a parameter. The driver reads it once and broadcasts its
bytes (a fixed file of a few MB); each worker process parses it once and keeps
a bounded table of words already encoded.

Defined results: a null text encodes like an empty one (no ids, decoded as the
empty string); special tokens written in a text become their single ids; ids
outside the vocabulary decode to nothing. Letters first assigned after the
tokenizer library's Unicode version follow the ``regex`` module's tables.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from curbwise.llm.batches import arrow_pass, ship_package, texts

#: Symbols up to which the plain scan is used; only speed depends on it.
LONG_WORD = 256
#: Words a worker remembers before it starts afresh; only speed depends on it.
KEPT_WORDS = 400_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte value in byte-level vocabularies.

    Printable Latin-1 characters stand for themselves; the other bytes take
    the code points from 256 on, in order.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(value) if value in plain else chr(next(spare)) for value in range(256)]


def merge_by_scan(word: str, bounds: list[int], ranks: dict[tuple[str, str], int]) -> list[int]:
    """Boundaries of the final parts of ``word``, starting from ``bounds``."""
    none = len(ranks)

    def rank_at(i: int) -> int:
        return ranks.get((word[bounds[i]:bounds[i + 1]], word[bounds[i + 1]:bounds[i + 2]]), none)

    row = [rank_at(i) for i in range(len(bounds) - 2)]
    while row:
        least = min(row)
        if least == none:
            break
        at = row.index(least)
        del bounds[at + 1], row[at]
        if at < len(row):
            row[at] = rank_at(at)
        if at:
            row[at - 1] = rank_at(at - 1)
    return bounds


def merge_by_heap(word: str, bounds: list[int], ranks: dict[tuple[str, str], int]) -> list[int]:
    """The same merges for a long word: smallest rank first, then leftmost."""
    ends = dict(zip(bounds, bounds[1:], strict=False))
    starts = {end: start for start, end in ends.items()}
    waiting: list[tuple[int, int, int, int]] = []

    def offer(start: int) -> None:
        middle = ends[start]
        if middle in ends:
            rank = ranks.get((word[start:middle], word[middle:ends[middle]]))
            if rank is not None:
                heapq.heappush(waiting, (rank, start, middle, ends[middle]))

    for start in bounds[:-1]:
        offer(start)
    while waiting:
        _, start, middle, end = heapq.heappop(waiting)
        if ends.get(start) != middle or ends.get(middle) != end:
            continue
        del ends[middle]
        ends[start], starts[end] = end, start
        offer(start)
        if start in starts:
            offer(starts[start])
    return [*sorted(ends), len(word)]


class WordBpe:
    """A parsed vocabulary file whose words end in a marker symbol."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model = spec["model"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.vocab: dict[str, int] = model["vocab"]
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(pairs)}
        self.end: str = model["end_of_word_suffix"] or ""
        self.specials: dict[str, int] = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.piece = regex.compile(pattern)
        self.special = regex.compile("|".join(map(regex.escape, self.specials)) or r"(?!)")
        self.symbols = byte_symbols()
        by_id = {number: token for token, number in {**self.vocab, **self.specials}.items()}
        self.tokens = pa.array([by_id.get(number) for number in range(max(by_id) + 1)], pa.string())
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of one pre-tokenised word as little-endian 32-bit integers."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            data = word.encode("utf-8")
            spelled = "".join(map(self.symbols.__getitem__, data)) + self.end
            bounds = [*range(len(data)), len(spelled)]
            merge = merge_by_scan if len(data) <= LONG_WORD else merge_by_heap
            parts = merge(spelled, bounds, self.ranks)
            ids = [self.vocab[spelled[a:b]] for a, b in zip(parts, parts[1:], strict=False)]
            found = self.words[word] = np.array(ids, "<i4").tobytes()
        return found

    def chunk(self, chunk: str) -> bytes:
        """Ids of a stretch of text without spaces."""
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")
        return b"".join(map(self.word, self.piece.findall(chunk.lower())))

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens; no piece ever spans a white space."""
        known = self.chunks
        chunks = text.replace("\n", " ").split(" ")
        for chunk in set(chunks).difference(known):
            known[chunk] = self.chunk(chunk)
        ids = b"".join(map(known.__getitem__, chunks))
        if len(known) >= KEPT_WORDS:
            known.clear()
        return ids

    def encode(self, text: str) -> bytes:
        if not any(token in text for token in self.specials):
            return self.plain(text)
        parts, at = [], 0
        for match in self.special.finditer(text):
            parts += [self.plain(text[at:match.start()]), np.array([self.specials[match[0]]], "<i4").tobytes()]
            at = match.end()
        return b"".join([*parts, self.plain(text[at:])])

    def encode_all(self, values: list[str]) -> pa.ListArray:
        found = [self.encode(value) for value in values]
        offsets = np.zeros(len(found) + 1, "<i4")
        np.cumsum([len(ids) // 4 for ids in found], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """Token strings joined by one space, as a file without a decoder asks for."""
        flat = ids.flatten()
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(self.tokens)))
        tokens = pc.take(self.tokens, pc.if_else(known, flat, pa.scalar(None, pa.int32())))
        if tokens.null_count:
            rows = ids.to_pylist()
            spelled = self.tokens.to_pylist()
            joined = [
                " ".join(spelled[i] for i in row or () if i is not None and 0 <= i < len(spelled) and spelled[i])
                for row in rows
            ]
            return pa.array(joined, pa.string())
        lengths = pc.fill_null(pc.list_value_length(ids), 0)
        offsets = np.zeros(len(ids) + 1, "<i4")
        np.cumsum(lengths, out=offsets[1:])
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), " ")


_parsed: dict[int, WordBpe] = {}


def _tokenizer(content: bytes) -> WordBpe:
    key = hash(content)
    if key not in _parsed:
        _parsed[key] = WordBpe(content)
    return _parsed[key]


def _shared(df: DataFrame, vocabulary: str):
    ship_package(df.sparkSession)
    return df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())


def encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the whole text's token ids in a new column; no shuffle."""
    shared = _shared(df, vocabulary)

    def make():
        tokenizer = _tokenizer(shared.value)
        return lambda part: [tokenizer.encode_all(texts(part, text))]

    return arrow_pass(df, f"`{ids}` array<int>", make)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the text that the ids stand for in a new column; null ids decode to ''."""
    shared = _shared(df, vocabulary)

    def make():
        tokenizer = _tokenizer(shared.value)
        return lambda part: [tokenizer.decode_all(part.column(ids))]

    return arrow_pass(df, f"`{decoded}` string", make)


def round_trip(
    df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded",
    drop: tuple[str, ...] = (),
) -> DataFrame:
    """Ids and the text decoded from them, in one pass over the rows."""
    shared = _shared(df, vocabulary)

    def make():
        tokenizer = _tokenizer(shared.value)

        def compute(part: pa.RecordBatch) -> list:
            encoded = tokenizer.encode_all(texts(part, text))
            return [encoded, tokenizer.decode_all(encoded)]

        return compute

    return arrow_pass(df, f"`{ids}` array<int>, `{decoded}` string", make, drop)
