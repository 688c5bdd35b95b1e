"""Operator 7: toxicity by class-conditional Kneser-Ney language models.

Words of the labelled training documents are counted per class: bigrams, and
the distinct left neighbours of a word (its continuation count). The ordinary
class's counts are scaled to the size of the toxic class, so that both models
lack as much evidence. A class's probability of a word is its discounted
continuation count on top of ``STEM_BACKOFF`` shared counts, split as the word's
stem (its first ``STEM`` characters) says; a word outside the tables has its
stem alone. So insults that are compounds or inflections, each too rare to
count, are known by how they begin. A stem's probability is its discounted count
plus a backoff that both classes share: the discounted mass, dealt out by the
number of classes it occurs in. A bigram adds its discounted count in the class
to ``BIGRAM_BACKOFF`` shared counts split as the lower order says. Rare
expressions thus get nearly the same probability in both models, and only what
one class uses clearly more often moves the score.

A toxic document is ordinary text with some toxic expressions, so the toxic
model is mixed with the ordinary one (``MIXTURE``); the difference of the two
log-likelihoods, normalised by length and by its square root, goes through a
logistic curve fitted on labelled documents of another fold than the counts, or
on the counted ones if that fold has none.

All labelled training rows are counted, in Spark, and nothing that is counted is
cut by number: every word seen at least ``LEAST_WORD`` times in labelled text,
every stem (a word with neither is unknown and moves nothing) and every bigram of
two such words seen at least ``LEAST_BIGRAM`` times is a row of one staged table
of what it adds to the evidence: a stem its own evidence, a word what it adds to
its stem's, a bigram what it adds to its second word's. Rows that add nothing, which
most rare bigrams of the ordinary class are, are left out. The most frequent rows,
``LOCAL`` at most, are broadcast and added where a text is read. The others, if
there are more, are joined by the same plan: a text's n-grams are grouped by n-gram in each task, so that a frequent
one is a row per block of texts, and a filter of fixed size keeps back only those
that are surely not in the table. Evidence counts in whole steps of 1 / ``UNIT``, so
neither ``LOCAL`` nor the filter nor the partitioning changes it. N-grams are
known by 64-bit hashes.
The logistic curve is fitted on at most ``CALIBRATION_ROWS`` labelled documents,
chosen by a hash of the id.

Extra columns of documents and labels are never looked at, whatever their names.

Defined results: null and empty texts score as the curve does at zero evidence
and below 0.5; repeated label rows count as often as they occur; labels that are
null or neither 0 nor 1 are left out; without labelled documents of both classes
every score is the share of toxic labels, or 0 without labels.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest

from curbwise.llm.batches import ROWS, fold, ship_package, stage, words_of

LEAST_WORD, LEAST_BIGRAM, STEM = 3, 2, 5
DISCOUNT, STEM_BACKOFF, BIGRAM_BACKOFF, MIXTURE = 0.75, 5.0, 20.0, 0.02
CALIBRATION_ROWS = 20_000
#: Labels up to this many rows are broadcast to the documents (some 25 MB); more are joined by shuffle.
BROADCAST_LABELS = 1_000_000
#: Distinct n-grams a task holds before it passes their counts on.
HELD = 400_000
#: Rows of the evidence table that are broadcast, the most frequent ones (16 bytes each); the rest is joined. Only speed
#: depends on it.
LOCAL = 2_000_000
#: Bits of the filter of the joined n-grams (16 MB), in words of 32; only speed depends on it.
FILTER_WORDS = 1 << 22
#: Evidence of 1 as an integer. A step is small beside the evidence of an insult; what rounds to no step is no row.
UNIT = 1 << 8
#: Words in a block of texts whose n-grams are grouped; words whose hashes a task remembers.
BLOCK_TOKENS, KEPT_WORDS = 500_000, 400_000
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def labelled(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> DataFrame:
    """Labelled training texts: (text, toxic, part), part being the fold of the id."""
    marks = labels.select(F.col("doc_id").alias("labelled"), "toxic").where("toxic IN (0, 1)")
    marks = marks.withColumn("part", fold(F.col("labelled"), modulus)).where(F.col("part") != held_out)
    if labels.count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    texts = docs.select("doc_id", "text")
    return texts.join(marks, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic", "part")


class Hasher:
    """Words to the 64-bit hashes of words and stems; remembers those seen."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.rows: list[tuple[int, int]] = []
        self.table = np.empty((0, 2), np.uint64)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """The rows of ``table`` (word, stem) that the words have."""
        for word in set(words).difference(self.known):
            self.known[word] = len(self.rows)
            stem = word.decode("utf-8", "replace")[:STEM].encode()
            self.rows.append((xxh3_64_intdigest(word), xxh3_64_intdigest(b"stem " + stem)))
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def hashes(self) -> np.ndarray:
        if len(self.table) < len(self.rows):
            new = np.array(self.rows[len(self.table):], np.uint64)
            self.table = np.concatenate([self.table, new])
        return self.table


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * _GOLDEN
    mixed = ((mixed ^ (mixed >> np.uint64(29))) + second) * _MIX
    return mixed ^ (mixed >> np.uint64(31))


def _counted(rows: DataFrame, bigrams: bool) -> DataFrame:
    """n0 and n1 of (word, stem) or of (first, second); counted in each task, then merged."""
    names = ["first", "second"] if bigrams else ["word", "stem"]

    def flush(held: list[Counter], hasher: Hasher) -> pa.RecordBatch:
        grams = [np.array(list(each.keys()), np.int64).reshape(-1, 2 if bigrams else 1) for each in held]
        at, table = np.concatenate(grams), hasher.hashes()
        columns = [table[at[:, 0], 0], table[at[:, 1], 0] if bigrams else table[at[:, 0], 1]]
        toxic = np.repeat(np.arange(2, dtype=np.int32), [len(each) for each in grams])
        n = np.array([n for each in held for n in each.values()], np.int64)
        arrays = [pa.array(np.ascontiguousarray(column).view(np.int64)) for column in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(toxic), pa.array(n)], [*names, "toxic", "n"])

    def run(batches):
        hasher, held = Hasher(), [Counter(), Counter()]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                data = part.column("text").cast(pa.binary()).to_pylist()
                for each, toxic in zip(data, part.column("toxic").to_pylist(), strict=True):
                    codes = hasher.codes(words_of(each)).tolist()
                    held[toxic].update(zip(codes, codes[1:], strict=False) if bigrams else codes)
                    if sum(map(len, held)) > HELD:
                        yield flush(held, hasher)
                        held = [Counter(), Counter()]
                        hasher.clear()
        yield flush(held, hasher)

    partial = rows.select("text", "toxic").mapInArrow(
        run, ", ".join(f"{name} bigint" for name in names) + ", toxic int, n bigint"
    )
    split = [F.sum(F.when(F.col("toxic") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)]
    return partial.groupBy(*names).agg(*split)


def _to_size(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts with the ordinary class's scaled to the size of the toxic class, and the factors."""
    totals = np.maximum(counts.sum(axis=0), 1)
    scale = np.array([totals[1] / totals[0], 1.0])
    return counts * scale, scale


class Model:
    """The model over arrays in memory: the plain statement of what ``evidence_table`` computes in Spark."""

    def __init__(
        self, words: list[bytes], left: np.ndarray, keys: np.ndarray, bigrams: np.ndarray,
        stems: list[str], stem_counts: np.ndarray,
    ) -> None:
        """``left`` has the continuation counts of each word (0: the unknown word), ``bigrams`` the counts of
        the ascending ``keys``, ``stem_counts`` those of the stems; all have a column per class, ordinary first."""
        self.place = {word: at + 1 for at, word in enumerate(words)}
        self.size = len(words) + 1
        self.stems = {stem: self.size + at for at, stem in enumerate(stems)}
        scaled, _ = _to_size(stem_counts)
        kinds = np.maximum((stem_counts > 0).sum(axis=1), 1)
        freed = np.minimum(scaled, DISCOUNT).sum(axis=0).mean()
        shared = np.maximum(scaled - DISCOUNT, 0) + (max(freed, 1.0) * kinds / max(kinds.sum(), 1))[:, None]
        shared = shared / shared.mean(axis=1, keepdims=True)
        # A row for each word, the unknown one first, and then for each stem.
        self.lower = np.concatenate([np.ones((self.size, 2)), shared])
        scaled, scale = _to_size(left)
        self.lower[1:self.size] = STEM_BACKOFF * self.lower[[self.stem(word) for word in words]]
        self.lower[1:self.size] += np.maximum(scaled - DISCOUNT, 0)[1:]
        self.lower /= self.lower.mean(axis=1, keepdims=True)
        self.keys = keys
        self.direct = np.maximum(bigrams * scale - DISCOUNT, 0)
        self.weights = np.zeros(4)

    def stem(self, word: bytes) -> int:
        return self.stems.get(word.decode("utf-8", "replace")[:STEM], 0)

    def evidence(self, words: list[bytes]) -> float:
        """Log-likelihood of the toxic model less that of the ordinary one."""
        if not words:
            return 0.0
        get, stem = self.place.get, self.stem
        codes = np.fromiter((get(word) or stem(word) for word in words), np.int64, len(words))
        mass = self.lower[codes]
        if len(self.keys):
            known = np.where(codes < self.size, codes, 0)
            wanted = known[:-1] * self.size + known[1:]
            at = np.searchsorted(self.keys, wanted)
            at[at == len(self.keys)] = 0
            hit = np.flatnonzero(self.keys[at] == wanted)
            mass[hit + 1] = BIGRAM_BACKOFF * mass[hit + 1] + self.direct[at[hit]]
        return float(np.floor(np.log1p(MIXTURE * (mass[:, 1] / mass[:, 0] - 1)) * UNIT + 0.5).sum() / UNIT)


class Fitted:
    """A fitted model: its frequent rows in arrays, a filter and a table of the others, and the curve."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, others: DataFrame | None, mask: np.ndarray) -> None:
        """``keys`` ascending; ``others`` has (key, value) and is not needed where texts are read."""
        self.keys, self.values, self.others, self.mask = keys, values, others, mask
        self.weights = np.zeros(4)

    def score(self, evidence: Column, words: Column) -> Column:
        x = [F.lit(1.0), *_features(evidence, words)]
        total = sum((w * each for w, each in zip(map(float, self.weights), x, strict=True)), F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _features(evidence: Column, words: Column) -> list[Column]:
    n = F.greatest(words, F.lit(1))
    clip = lambda value, most: F.least(F.greatest(value, F.lit(-most)), F.lit(most))
    return [clip(evidence, 10.0), clip(10 * evidence / n, 2.0), clip(evidence / F.sqrt(n), 5.0)]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton's method for a ridge-penalised logistic curve."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (y - p) - ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, held_out: int = 0) -> Fitted | float:
    """Count the labelled training documents and fit the curve; a constant where a class is missing.

    The fold after the held-out one fits the curve; the other folds are counted.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = stage(labelled(docs, labels, modulus, held_out), "toxic-labelled")
    shares = {row["toxic"]: row["n"] for row in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return float(shares.get(1, 0) > 0)
    curve_part = (held_out + 1) % modulus
    counted = rows.where(F.col("part") != curve_part)
    model = _split(stage(evidence_table(counted), "toxic-evidence"))
    curve = rows.where(F.col("part") == curve_part)
    _calibrate(model, counted if curve.isEmpty() else curve)
    return model


def _scale(counts: DataFrame) -> float:
    """What brings the ordinary class's counts to the size of the toxic class."""
    total = counts.agg(*[F.coalesce(F.sum(f"n{c}"), F.lit(0)).alias(f"n{c}") for c in (0, 1)]).first()
    return max(total["n1"], 1) / max(total["n0"], 1)


def _fixed(mass: list[Column]) -> Column:
    """Evidence of a word of these probabilities, as an integer."""
    return F.floor(F.log1p(MIXTURE * (mass[1] / mass[0] - 1)) * UNIT + 0.5).cast("bigint")


def _halves(mass: list[Column], name: str) -> list[Column]:
    """The two columns with a mean of 1."""
    return [(2 * each / (mass[0] + mass[1])).alias(f"{name}{c}") for c, each in enumerate(mass)]


def evidence_table(rows: DataFrame) -> DataFrame:
    """(key, value, seen): what each stem, word and bigram of (text, toxic) adds to the evidence, where it adds anything."""
    n = [F.col("n0"), F.col("n1")]
    seen = n[0] + n[1]
    words = stage(_counted(rows, False), "toxic-words")
    grams = stage(_counted(rows, True), "toxic-bigrams")
    stems = stage(words.groupBy("stem").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "toxic-stems")
    scale = _scale(words)
    scaled = [n[0] * scale, n[1] * 1.0]
    kinds = (n[0] > 0).cast("int") + (n[1] > 0).cast("int")
    # Whole numbers, so that the order of addition does not matter.
    freed = [F.sum(F.round(F.least(each, F.lit(DISCOUNT)) * (1 << 20)).cast("bigint")).alias(f"f{c}") for c, each in enumerate(scaled)]
    mass = stems.agg(*freed, F.sum(kinds).alias("kinds")).first()
    each_kind = max(((mass["f0"] or 0) + (mass["f1"] or 0)) / (2 << 20), 1.0) / max(mass["kinds"] or 0, 1)
    shared = [F.greatest(each - DISCOUNT, F.lit(0.0)) + each_kind * kinds for each in scaled]
    stems = stems.select("stem", seen.alias("seen"), *_halves(shared, "s"))
    of_stem = _fixed([F.col("s0"), F.col("s1")])

    left = grams.groupBy(F.col("second").alias("word")).agg(
        *[F.sum((each > 0).cast("bigint")).alias(f"k{c}") for c, each in enumerate(n)]
    )
    scale = _scale(left.withColumnsRenamed({"k0": "n0", "k1": "n1"}))
    frequent = words.where(seen >= LEAST_WORD).select("word", "stem", seen.alias("seen"))
    known = frequent.join(left, "word", "left").join(stems.drop("seen"), "stem")
    follows = [F.coalesce(F.col("k0"), F.lit(0)) * scale, F.coalesce(F.col("k1"), F.lit(0)) * 1.0]
    lower = [
        STEM_BACKOFF * F.col(f"s{c}") + F.greatest(each - DISCOUNT, F.lit(0.0)) for c, each in enumerate(follows)
    ]
    known = stage(known.select("word", "seen", of_stem.alias("of_stem"), *_halves(lower, "w")), "toxic-known")
    of_word = _fixed([F.col("w0"), F.col("w1")])

    direct = [F.greatest(each - DISCOUNT, F.lit(0.0)) for each in (n[0] * scale, n[1] * 1.0)]
    pairs = (
        grams.where(seen >= LEAST_BIGRAM)
        .join(known.select(F.col("word").alias("first")), "first", "left_semi")
        .join(known.drop("seen").withColumnRenamed("word", "second"), "second")
    )
    of_pair = _fixed([BIGRAM_BACKOFF * F.col(f"w{c}") + each for c, each in enumerate(direct)])

    def keyed(batches):
        for batch in batches:
            first, second = (batch.column(name).to_numpy().view(np.uint64) for name in ("first", "second"))
            key = pa.array(pair_hash(first, second).view(np.int64))
            yield pa.RecordBatch.from_arrays([key, batch.column("value"), batch.column("seen")], ["key", "value", "seen"])

    pairs = pairs.select("first", "second", (of_pair - of_word).alias("value"), seen.alias("seen"))
    return (
        stems.select(F.col("stem").alias("key"), of_stem.alias("value"), "seen")
        .unionByName(known.select(F.col("word").alias("key"), (of_word - F.col("of_stem")).alias("value"), "seen"))
        .unionByName(pairs.where("value <> 0").mapInArrow(keyed, "key bigint, value bigint, seen bigint"))
        .where("value <> 0")
    )


def _split(table: DataFrame) -> Fitted:
    """The most frequent rows as arrays, the others as a table with its filter."""
    # Rows seen about as often are told apart by their hash, so that the arrays are nearly filled.
    level = F.floor(F.log2(F.col("seen").cast("double")) * 4).cast("int") * 16
    table = table.withColumn("level", level + F.col("key").bitwiseAND(F.lit(15)).cast("int"))
    least, room = 1 << 30, LOCAL
    for row in table.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        if row["n"] > room:
            break
        least, room = row["level"], room - row["n"]
    near, others = table.where(F.col("level") >= least), table.where(F.col("level") < least)
    near = near.select("key", "value").toArrow()
    keys, values = near.column("key").to_numpy().view(np.uint64), near.column("value").to_numpy()
    order = np.argsort(keys)
    mask = np.zeros(FILTER_WORDS, np.uint32)
    slot = F.shiftrightunsigned("key", 5).bitwiseAND(F.lit(FILTER_WORDS - 1)).alias("slot")
    one = F.expr("shiftleft(1L, CAST(key & 31 AS INT))")
    found = others.groupBy(slot).agg(F.bit_or(one).alias("bits")).toArrow()
    mask[found.column("slot").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    others = others.select("key", "value")
    return Fitted(keys[order], values[order], others, mask)


def _calibrate(model: Fitted, rows: DataFrame) -> None:
    sample = rows.orderBy(F.xxhash64("doc_id")).limit(CALIBRATION_ROWS)
    found = with_evidence(sample.select(F.col("toxic").alias("doc"), "text"), model).select(
        F.col("doc").cast("double").alias("toxic"), *[
            each.cast("double").alias(f"x{at}") for at, each in enumerate(_features(F.col("evidence"), F.col("n_words")))
        ]
    ).toArrow()
    x = np.stack([np.ones(found.num_rows), *[found.column(f"x{at}").to_numpy() for at in range(3)]], axis=1)
    if len(x):
        order = np.lexsort([*x.T, found.column("toxic").to_numpy()])
        model.weights = _logistic(x[order], found.column("toxic").to_numpy()[order])


class Reader:
    """Adds up what a block of texts finds in the arrays, and lists by n-gram what it must ask the table for."""

    def __init__(self, model: Fitted) -> None:
        self.model, self.hasher = model, Hasher()

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values in the arrays (0 for none), and which keys may be in the table."""
        at = np.searchsorted(self.model.keys, keys)
        at[at == len(self.model.keys)] = 0
        hit = self.model.keys[at] == keys if len(self.model.keys) else np.zeros(len(keys), bool)
        values = np.where(hit, self.model.values[at], 0) if len(self.model.keys) else np.zeros(len(keys), np.int64)
        bits = self.model.mask[(keys >> np.uint64(5)) & np.uint64(FILTER_WORDS - 1)]
        return values, ~hit & ((bits >> (keys & np.uint64(31)).astype(np.uint32)) & np.uint32(1)).astype(bool)

    def block(self, rows: list[list[bytes]]) -> tuple[np.ndarray, list[int], list[bytes]]:
        """Sums per text; keys to ask for; for each the pairs (text, times) as bytes."""
        sizes = np.array([len(words) for words in rows])
        if len(self.hasher.known) > KEPT_WORDS:
            self.hasher.clear()
        codes = np.concatenate([self.hasher.codes(words) for words in rows])
        text = np.repeat(np.arange(len(rows)), sizes)
        hashes = self.hasher.hashes()
        inside = text[1:] == text[:-1]
        pairs = pair_hash(hashes[codes[:-1], 0], hashes[codes[1:], 0])[inside]
        sums = np.zeros(len(rows), np.int64)
        asked = []
        for keys, owner in ((None, text), (pairs, text[1:][inside])):
            if keys is None:
                used, at = np.unique(codes, return_inverse=True)
                looked = [self.look(hashes[used, column]) for column in (0, 1)]
                np.add.at(sums, owner, (looked[0][0] + looked[1][0])[at])
                for column, (_, open_) in enumerate(looked):
                    here = np.flatnonzero(open_[at])
                    asked.append((hashes[codes[here], column], owner[here]))
            else:
                values, open_ = self.look(keys)
                np.add.at(sums, owner, values)
                asked.append((keys[open_], owner[open_]))
        keys, owner = (np.concatenate(each) for each in zip(*asked, strict=True))
        order = np.lexsort([owner, keys])
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        start = np.flatnonzero(new)
        listed = np.stack([owner[start], np.diff(np.append(start, len(keys)))], axis=1).astype("<i4")
        first = np.ones(len(start), bool)
        first[1:] = keys[start][1:] != keys[start][:-1]
        cuts = np.append(np.flatnonzero(first), len(start))
        data = listed.tobytes()
        lists = [data[8 * a:8 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        return sums, keys[start][first].view(np.int64), lists


def with_evidence(docs: DataFrame, model: Fitted) -> DataFrame:
    """(doc, evidence, n_words) of each row of (doc, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((model.keys, model.values, model.mask))
    kind = docs.schema["doc"].dataType
    schema = T.StructType([T.StructField("doc", kind), *T._parse_datatype_string(
        "row bigint, n_words bigint, found bigint, key bigint, places binary"
    ).fields])

    def run(batches):
        keys, values, mask = shared.value
        reader = Reader(Fitted(keys, values, None, mask))
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc, data = batch.column("doc"), batch.column("text").cast(pa.binary())
            at = 0
            while at < len(doc):
                rows, tokens, begin = [], 0, at
                while at < len(doc) and tokens < BLOCK_TOKENS:
                    rows.append(words_of(data[at].as_py()))
                    tokens += len(rows[-1])
                    at += 1
                sums, asked, lists = reader.block(rows)
                n, m = len(rows), len(asked)
                yield pa.RecordBatch.from_arrays([
                    doc.slice(begin, n), pa.array(np.arange(row, row + n)), pa.array([len(each) for each in rows], pa.int64()),
                    pa.array(sums), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                ], schema.fieldNames())
                if m:
                    yield pa.RecordBatch.from_arrays([
                        pa.nulls(m, doc.type), pa.array(np.full(m, row)), pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.int64()), pa.array(asked), pa.array(lists, pa.binary()),
                    ], schema.fieldNames())
                row += n

    parts = docs.select("doc", "text").mapInArrow(run, schema)
    def add(batches):
        for batch in batches:
            places = batch.column("places")
            pairs = np.frombuffer(b"".join(places.to_pylist()), "<i4").reshape(-1, 2).astype(np.int64)
            many = np.array([len(each.as_py()) // 8 for each in places], np.int64)
            ids = np.repeat(batch.column("row").to_numpy(), many) + pairs[:, 0]
            used, at = np.unique(ids, return_inverse=True)
            sums = np.zeros(len(used), np.int64)
            np.add.at(sums, at, np.repeat(batch.column("value").to_numpy(), many) * pairs[:, 1])
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums)], ["row", "more"])

    parts = stage(parts, "toxic-grams")
    asked = parts.where("key IS NOT NULL").select("key", "row", "places").join(model.others, "key")
    sums = asked.select("row", "value", "places").mapInArrow(add, "row bigint, more bigint")
    sums = sums.groupBy("row").agg(F.sum("more").alias("more"))
    rows = parts.where("key IS NULL").select("doc", "row", "n_words", "found").join(sums, "row", "left")
    found = (F.col("found") + F.coalesce(F.col("more"), F.lit(0))) / UNIT
    return rows.select("doc", found.alias("evidence"), "n_words")


def score(docs: DataFrame, model: Fitted | float) -> DataFrame:
    """doc_id, evidence, n_words, score and predicted for each document."""
    if isinstance(model, float):
        scored = docs.select("doc_id", F.lit(0.0).alias("evidence"), F.lit(0).cast("bigint").alias("n_words"),
                             F.lit(model).alias("score"))
    else:
        scored = with_evidence(docs.select(F.col("doc_id").alias("doc"), "text"), model).select(
            F.col("doc").alias("doc_id"), "evidence", "n_words",
            model.score(F.col("evidence"), F.col("n_words")).alias("score"),
        )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def harmless(docs: DataFrame, model: Fitted | float) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns only."""
    if isinstance(model, float):
        return docs if model < 0.5 else docs.limit(0)
    # A score depends on the text alone, so rows are found again by a hash of it.
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    scored = with_evidence(docs.select(key.alias("doc"), "text"), model)
    toxic = stage(
        scored.where(model.score(F.col("evidence"), F.col("n_words")) >= 0.5).select("doc").distinct(), "toxic-texts"
    )
    if toxic.count() <= BROADCAST_LABELS:
        toxic = F.broadcast(toxic)
    return docs.join(toxic, key == toxic["doc"], "left_anti")
