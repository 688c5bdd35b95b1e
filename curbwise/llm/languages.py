"""Operator 9: language identification with a bit-sliced Bloom filter of n-grams.

One table of 64-bit masks serves all languages: an n-gram has ``PROBES`` slots,
bit l of all of them is set when language l has the n-gram, and the AND of the
slots names every language that (apart from false positives) contains it. A
text counts, per language, how many of its n-grams carry that language's bit.
A language whose bit is set in a share f of the slots says yes by chance with
probability f ** PROBES; each count is corrected for that, and the largest
corrected share decides, the smallest name among equals.

The n-grams of a language are those of its training texts that make up at least
``LEAST_SHARE`` of them, and at least ``LEAST_RELATIVE`` of their share in the
language that uses them most; stray foreign passages thus leave no mark. Counts
cover all training texts and are merged in Spark; an n-gram is counted by a
40-bit hash. The table has a fixed size (``SLOTS`` masks), more than 64
languages take further masks per slot.

Defined results: null texts and texts without a letter are ``und`` with score
0; without any training text everything is ``und``; a null or held-out training
row is never counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import ROWS, arrow_pass, fold, ship_package, stage, texts

SIZES = (3, 4)
SLOTS = 1 << 20
PROBES = 2
LEAST_SHARE, LEAST_RELATIVE = 1e-5, 0.2
UNKNOWN = "und"
#: Distinct n-grams a task holds before it passes their counts on.
HELD = 1_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def grams(text: str) -> np.ndarray:
    """Hashes (40 bits) of all character n-grams of the lower-cased text that start or end at a letter."""
    lowered = f" {text.lower()} "
    chars = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), "<u4")
    # Digits and marks say nothing of a language: everything that is no letter reads as a space.
    letters = _letter_table()
    chars = np.where(letters[np.minimum(chars, len(letters) - 1)] | (chars >= len(letters)), chars, np.uint32(32))
    codes = chars.astype(np.uint64)
    out = []
    for size in SIZES:
        count = len(codes) - size + 1
        if count <= 0:
            continue
        hashed = np.full(count, size, np.uint64)
        for at in range(size):
            hashed = hashed * _BASE + codes[at:at + count]
        hashed = (hashed ^ (hashed >> np.uint64(32))) * _MIX
        useful = (chars[:count] != 32) | (chars[size - 1:] != 32)
        out.append((hashed >> np.uint64(24))[useful])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """Which code points of the basic plane are letters; higher ones pass as they are."""
    if not _letters:
        _letters.append(np.array([chr(code).isalpha() for code in range(0x10000)]))
    return _letters[0]


def slots_of(hashes: np.ndarray) -> list[np.ndarray]:
    """The n-grams' places in the table, one array per probe."""
    mask = np.uint64(SLOTS - 1)
    return [((hashes >> np.uint64(20 * probe)) & mask).astype(np.int64) for probe in range(PROBES)]


class Model:
    def __init__(self, languages: list[str], hashes: np.ndarray, owners: np.ndarray) -> None:
        self.languages = languages
        words = max(1, -(-len(languages) // 64))
        self.table = np.zeros((SLOTS, words), np.uint64)
        bit = np.uint64(1) << (owners % 64).astype(np.uint64)
        for slot in slots_of(hashes):
            np.bitwise_or.at(self.table, (slot, owners // 64), bit)
        fill = [float(self._has(self.table, l).mean()) for l in range(len(languages))]
        self.chance = np.array(fill) ** PROBES

    @staticmethod
    def _has(masks: np.ndarray, language: int) -> np.ndarray:
        return (masks[:, language // 64] >> np.uint64(language % 64)) & np.uint64(1)

    def predict(self, text: str) -> tuple[str, float]:
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        hashes = grams(text)
        masks = None
        for slot in slots_of(hashes):
            masks = self.table[slot] if masks is None else masks & self.table[slot]
        n = len(hashes)
        hits = np.array([int(self._has(masks, l).sum()) for l in range(len(self.languages))])
        corrected = np.maximum(hits - n * self.chance, 0) / np.maximum(n * (1 - self.chance), 1e-9)
        best = int(np.argmax(corrected))
        return self.languages[best], float(min(1.0, corrected[best]))


def fit(docs: DataFrame, modulus: int = 4, held_out: int = 2) -> Model:
    """The filter over all training documents: those with a language and not of the held-out fold."""
    ship_package(docs.sparkSession)
    rows = docs.where(F.col("lang").isNotNull() & (fold(F.col("doc_id"), modulus) != held_out)).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def merged(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            distinct, place = np.unique(hashes, return_inverse=True)
            return distinct, np.bincount(place, counts, len(distinct)).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, (hashes, counts) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(hashes)), pa.array(hashes.astype(np.int64)), pa.array(counts)],
                    ["lang", "gram", "n"],
                )
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                by_lang: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), texts(part, "text"), strict=True):
                    by_lang.setdefault(lang, []).append(grams(text))
                for lang, found in by_lang.items():
                    hashes, counts = np.unique(np.concatenate(found), return_counts=True)
                    old = held.get(lang, (np.empty(0, np.uint64), np.empty(0, np.int64)))
                    held[lang] = merged(np.concatenate([old[0], hashes]), np.concatenate([old[1], counts]))
                if sum(len(hashes) for hashes, _ in held.values()) > HELD:
                    yield from flush()
        yield from flush()

    counted = rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counted = stage(counted, "language-grams")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counted.join(F.broadcast(totals), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    shares = shares.where(F.col("share") >= LEAST_SHARE)
    # At most 1 / LEAST_SHARE n-grams per language are left, whatever the input.
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    found = shares.join(most, "gram").where(F.col("share") >= LEAST_RELATIVE * F.col("most")).select("lang", "gram").toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    place = {name: at for at, name in enumerate(names)}
    owners = np.array([place[name] for name in found.column("lang").to_pylist()], np.int64)
    return Model(names, found.column("gram").to_numpy().astype(np.uint64), owners)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for each document; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def compute(part: pa.RecordBatch) -> list:
            found = [shared.value.predict(text) for text in texts(part, "text")]
            return [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]

        return compute

    return arrow_pass(docs.select("doc_id", "text"), "lang_pred string, score double", make, drop=("text",))
