"""Operator 6: near-duplicates by weighted MinHash (BagMinHash) over five-word shingles.

A text is the multiset of its runs of five lower-cased words (a text of one to
four words is a single shingle). The similarity of two texts is the weighted
Jaccard index of their multisets, and 0.8 or more makes a link.

Signature. The weight axis of a shingle is cut at 0, 1, 2, 4, 8, ...; each block
carries a Poisson process over time whose points have a register and, by their
bits, a place in the block: every bit chooses a half, so a point lies in the
part of the block below a text's weight or is passed over by that text. All
texts see the same points, the earliest point in a register is its value, and
two texts agree in a register with a probability equal to their similarity.
Points are drawn in order of time and only until every register has one, so the
work is near n + m log m for n shingles and m registers.

Links. Equal texts share one key (md5) and take part once. Each band of six
registers is a bucket. Every member is compared with the bucket's leader, the
member with the largest buckets in all bands, so that a group of copies gathers
around the text nearest to all of them; the links join texts to components.
Then every text that shares a bucket with a component without belonging to it is
held against all of that component and the others of its kind, in blocks:
signatures first, and the pairs that may reach 0.8 by their texts, so nothing is
lost because it does not touch a leader. Links are exact, on the multisets.

What a pair misses: with 30 bands a pair at exactly 0.8 shares no bucket with
probability 1e-4, and pairs whose signatures agree in less than 0.7 of the
registers (3.4 standard deviations under 0.8) are not compared.

Defined results: null and empty texts and texts without a word have no shingles
and are each alone in a class of their own; a null ``doc_id`` forms links like
any other, and as a class id only where no member has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from curbwise.llm.batches import arrow_pass, ship_package, stage
from curbwise.llm.components import components

SHINGLE = 5
BANDS, BAND_ROWS = 30, 6
REGISTERS = BANDS * BAND_ROWS
SIMILARITY = 0.8
#: Agreement of signatures below which a pair is not compared.
LEAST_ESTIMATE = 0.65
#: Members and shingles in a block of the second step: about 2 MB.
BLOCK, BLOCK_WEIGHT = 512, 200_000
#: Words a task remembers before it starts afresh; only speed depends on it.
KEPT_WORDS = 400_000

#: A text with more than one in so many of all rows has its class broadcast; there are fewer such texts than this.
HOT_SHARE = 1000

_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(values: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    values = (values ^ (values >> np.uint64(30))) * _MIX1
    values = (values ^ (values >> np.uint64(27))) * _MIX2
    return values ^ (values >> np.uint64(31))


class Shingler:
    """Distinct 64-bit shingle hashes of texts, ascending, and their counts; remembers the words' hashes."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").lower().split()
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        if len(self.known) > KEPT_WORDS:
            self.known.clear()
        for word in set(words).difference(self.known):
            self.known[word] = xxh3_64_intdigest(word)
        codes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        size = min(SHINGLE, len(codes))
        hashed = np.zeros(len(codes) - size + 1, np.uint64)
        for at in range(size):
            hashed = mix(hashed + codes[at:at + len(hashed)] + _GOLDEN)
        return np.unique(hashed, return_counts=True)


def signatures(docs: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash registers of each multiset: the time of the earliest point, infinite without shingles."""
    owner = np.repeat(np.arange(len(docs)), [len(hashes) for hashes, _ in docs])
    element = np.concatenate([hashes for hashes, _ in docs]) if docs else np.empty(0, np.uint64)
    weight = np.concatenate([counts for _, counts in docs]) if docs else np.empty(0, np.int64)
    parts = [(owner, mix(element), np.ones(len(owner), np.int64), np.ones(len(owner), np.int64))]
    low = 1
    while len(weight) and (above := weight > low).any():
        # The block (low, 2 low]: low units wide, of which the text owns the first weight - low.
        owner, element, weight = owner[above], element[above], weight[above]
        seed = mix(element ^ mix(np.full(len(element), low, np.uint64)))
        parts.append((owner, seed, np.full(len(owner), low, np.int64), np.minimum(weight - low, low)))
        low *= 2
    owner, seed, width, own = (np.concatenate(column) for column in zip(*parts, strict=True))
    found = np.full(len(docs) * registers, np.inf)
    time = np.zeros(len(owner))
    step = 0
    while len(owner):
        step += 1
        drawn = mix(seed + np.uint64((step * 0x9E3779B97F4A7C15) % 2**64))
        time = time - np.log((drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / width
        bits = mix(drawn ^ _MIX2)
        register = ((bits >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
        inside = (bits & np.uint64(0xFFFFFFFF)).astype(np.int64) % width < own
        np.minimum.at(found, (owner * registers + register)[inside], time[inside])
        last = found.reshape(-1, registers).max(axis=1)
        going = time < last[owner]
        owner, seed, width, own, time = owner[going], seed[going], width[going], own[going], time[going]
    return found.reshape(len(docs), registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard index of two multisets."""
    _, left, right = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][left], b[1][right]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0


def _sign(docs: DataFrame) -> DataFrame:
    """``weight`` (shingles) and ``sig`` (4 bytes per register) for each text; no shuffle."""

    def make():
        shingler = Shingler()

        def compute(part: pa.RecordBatch) -> list:
            bags = [shingler(text) for text in part.column("text").to_pylist()]
            short = (mix(signatures(bags).view(np.uint64)) >> np.uint64(32)).astype("<u4")
            weights = [int(counts.sum()) for _, counts in bags]
            return [
                pa.array(weights, pa.int64()),
                pa.array([row.tobytes() if n else None for row, n in zip(short, weights, strict=True)], pa.binary()),
            ]

        return compute

    return arrow_pass(docs, "weight bigint, sig binary", make, drop=("text",))


def _banded(nodes: DataFrame) -> DataFrame:
    """A row (bucket, node) for each band of each node."""
    width = BAND_ROWS * 4
    buckets = F.array(*[
        F.xxhash64(F.lit(band), F.substring("sig", band * width + 1, width)) for band in range(BANDS)
    ])
    return nodes.select("node", F.explode(buckets).alias("bucket"))


def _promising(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that fit in size and whose signatures do not rule out the similarity."""
    ends = nodes.select("node", "weight", "sig")
    both = pairs
    for end in ("a", "b"):
        both = both.join(ends.toDF(end, f"weight_{end}", f"sig_{end}"), end)
    sized = both.where(
        F.least("weight_a", "weight_b") >= F.lit(SIMILARITY) * F.greatest("weight_a", "weight_b")
    ).select("a", "b", "sig_a", "sig_b")

    def make():
        def compute(part: pa.RecordBatch) -> list:
            left, right = (
                np.frombuffer(b"".join(part.column(c).to_pylist()), "<u4").reshape(-1, REGISTERS) for c in ("sig_a", "sig_b")
            )
            return [pa.array((left == right).mean(axis=1))]

        return compute

    agreed = arrow_pass(sized, "agreement double", make, drop=("sig_a", "sig_b"))
    return agreed.where(F.col("agreement") >= LEAST_ESTIMATE).select("a", "b")


def _spelled(wanted: DataFrame, nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """The texts of the wanted nodes, each found again by the id and key of the row it was made from."""
    rows = nodes.join(wanted, "node").select("node", F.col("doc_id").alias("id"), F.col("key").alias("want"))
    found = keyed.join(rows, (F.col("key") == F.col("want")) & F.col("doc_id").eqNullSafe(F.col("id")))
    return stage(found.select("node", "text"), "near-texts")


def _verified(pairs: DataFrame, spelled: DataFrame) -> DataFrame:
    """The pairs of nodes whose multisets have a similarity of at least 0.8."""
    both = pairs
    for end in ("a", "b"):
        both = both.join(spelled.toDF(end, f"text_{end}"), end)

    def make():
        shingler = Shingler()

        def compute(part: pa.RecordBatch) -> list:
            pair = zip(part.column("text_a").to_pylist(), part.column("text_b").to_pylist(), strict=True)
            return [pa.array([similarity(shingler(x), shingler(y)) for x, y in pair], pa.float64())]

        return compute

    measured = arrow_pass(both, "similarity double", make, drop=("text_a", "text_b"))
    return measured.where(F.col("similarity") >= SIMILARITY).select("a", "b").distinct()


def _between(crowded: DataFrame, joined: DataFrame, nodes: DataFrame, spelled: DataFrame) -> DataFrame:
    """Links between the components that meet in a bucket, found block by block.

    Of the components in a bucket the largest is its main one; the other texts
    of the bucket are guests of that component. Guests are held against all
    members and guests. A task holds one pair of blocks at a time however large
    the component is, and only links leave it; a guest that has a link to a
    component needs no second one.
    """
    spark = crowded.sparkSession
    placed = crowded.join(joined, "node", "left").withColumn("part", F.coalesce("component", "node"))
    parts = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("bucket").agg(
        F.max_by("part", F.expr("shiftleft(n, 20) + pmod(xxhash64(part), 1048576)")).alias("main"),
        F.count(F.lit(1)).alias("n_parts"),
    ).where("n_parts > 1")
    guests = stage(
        placed.join(mixed, "bucket").where("part != main").select("main", "node", "part").distinct(), "near-guests"
    )
    mains = guests.select("main").distinct()
    members = placed.select("node", "part").distinct().join(mains, F.col("part") == F.col("main"))
    rows = guests.select("*", F.lit(True).alias("guest")).union(members.select("main", "node", "part", F.lit(False)))
    full = rows.join(nodes.select("node", "weight", "sig"), "node").join(spelled, "node")
    sizes = rows.join(nodes.select("node", "weight"), "node").groupBy("main").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("weight") / BLOCK_WEIGHT)).alias("chunks")
    )
    held = stage(
        full.join(sizes, "main").withColumn("chunk", F.expr("pmod(xxhash64(node), chunks)")), "near-open"
    )
    member = F.struct("node", "part", "weight", "sig", "text")
    every = held.groupBy("main", "chunk").agg(F.collect_list(member).alias("right"))
    left = held.where("guest").groupBy("main", F.col("chunk").alias("own"), "chunks").agg(F.collect_list(member).alias("left"))
    blocks = (
        left.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .join(every, ["main", "chunk"]).select("left", "right")
    )

    def run(batches):
        shingler = Shingler()
        for batch in batches:
            for at in range(batch.num_rows):
                a, b = _block_links(*(batch.column(c).slice(at, 1) for c in ("left", "right")), shingler)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    # A pair of blocks is a large row: a batch of the usual number of rows would not fit.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, 4)
    try:
        return stage(blocks.mapInArrow(run, "a bigint, b bigint").distinct(), "near-between")
    finally:
        spark.conf.set(key, usual)


def _block_links(left: pa.ListArray, right: pa.ListArray, shingler: Shingler) -> tuple[list[int], list[int]]:
    def read(column: pa.ListArray):
        rows = column.flatten()
        node, part, weight, sig, text = (rows.field(name) for name in ("node", "part", "weight", "sig", "text"))
        table = np.frombuffer(b"".join(sig.to_pylist()), "<u4").reshape(-1, REGISTERS)
        return node.to_numpy(), part.to_numpy(), weight.to_numpy(), table, text

    left_node, left_part, left_weight, left_sig, left_text = read(left)
    right_node, right_part, right_weight, right_sig, right_text = read(right)
    bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    found: tuple[list[int], list[int]] = ([], [])
    for i in range(len(left_node)):
        agreed = (right_sig == left_sig[i]).sum(axis=1)
        fits = np.minimum(right_weight, left_weight[i]) >= SIMILARITY * np.maximum(right_weight, left_weight[i])
        open_ = np.flatnonzero((agreed >= LEAST_ESTIMATE * REGISTERS) & fits & (right_part != left_part[i]))
        linked: set[int] = set()
        own = shingler(left_text[i].as_py()) if len(open_) else None
        for j in open_[np.argsort(-agreed[open_], kind="stable")].tolist():
            if int(right_part[j]) not in linked:
                if j not in bags:
                    bags[j] = shingler(right_text[j].as_py())
                if similarity(own, bags[j]) >= SIMILARITY:
                    linked.add(int(right_part[j]))
                    found[0].append(int(min(left_node[i], right_node[j])))
                    found[1].append(int(max(left_node[i], right_node[j])))
    return found


def _key(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def _find(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Every row's id and key, and for each key with a word its class: both written tables."""
    ship_package(docs.sparkSession)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _key(text).alias("key"))
    # Row numbers are fixed once they are written.
    signed = stage(_sign(keyed).withColumn("row", F.monotonically_increasing_id()), "near-signed")
    stands = signed.where("weight > 0").groupBy("key").agg(F.min("row").alias("node"))
    nodes = stage(
        signed.join(stands.select("node"), signed["row"] == stands["node"])
        .select("node", "doc_id", "key", "weight", "sig"), "near-nodes",
    )
    banded = _banded(nodes)
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    crowded = stage(banded.join(shared, "bucket").select("bucket", "node", "members"), "near-buckets")
    # The last bits tell equals apart.
    reach = crowded.groupBy("node").agg(F.sum("members").alias("reach")).select(
        "node", F.expr("shiftleft(reach, 20) + pmod(xxhash64(node), 1048576)").alias("reach")
    )
    ranked = crowded.join(reach, "node")
    leaders = ranked.groupBy("bucket").agg(F.max_by("node", "reach").alias("leader"))
    stars = crowded.join(leaders, "bucket").where("node != leader").select(
        F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")
    ).distinct()
    # All texts move once to find those of the buckets, which serve both steps.
    spelled = _spelled(crowded.select("node").distinct(), nodes, keyed)
    links = stage(_verified(stage(_promising(stars, nodes), "near-pairs"), spelled), "near-links")
    joined = components(links, "a", "b")

    more = _between(crowded, joined, nodes, spelled)
    if not more.isEmpty():
        joined = components(links.union(more), "a", "b")
    copies = signed.where("weight > 0").groupBy("key").agg(
        F.min("row").alias("node"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies")
    )
    member = copies.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = member.groupBy("component").agg(
        F.min("least_id").alias("class_id"), F.min_by("node", F.coalesce("least_id", F.lit(2**63 - 1))).alias("head")
    )
    by_key = stage(
        member.join(named, "component").select(F.col("key").alias("its_key"), "node", "class_id", "head", "copies"), "near-classes"
    )
    return signed, by_key


def _with_class(rows: DataFrame, by_key: DataFrame) -> DataFrame:
    """Rows with a ``key`` and the class of their text.

    A text that very many rows have would be one key of the join, so the few
    such texts go by a broadcast.
    """
    total = by_key.agg(F.sum("copies")).first()[0] or 0
    hot = F.broadcast(by_key.where(F.col("copies") * HOT_SHARE > total))
    found = rows.join(hot, F.col("key") == F.col("its_key"))
    others = rows.join(hot.select("its_key"), F.col("key") == F.col("its_key"), "left_anti")
    return found.unionByName(others.join(by_key, F.col("key") == F.col("its_key")))


def has_words(text: str) -> Column:
    """Is there a character that is no white space, as ``str.split`` knows it?"""
    space = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    return F.coalesce(F.col(text).rlike(f"[^{space}]"), F.lit(False))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per row of ``docs``: doc_id and class_id, the least id of its class."""
    signed, by_key = _find(docs, doc_id, text)
    alone = signed.where("weight = 0").select("doc_id", F.col("doc_id").alias("class_id"))
    grouped = _with_class(signed.where("weight > 0").select("doc_id", "key"), by_key)
    return alone.unionByName(grouped.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id")))


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one of each class left, that of the least id; rows without words all stay.

    Of several rows with that id and text the first in the order of their other columns stays.
    """
    _, by_key = _find(docs, doc_id, text)
    names = {name: f"c{place}" for place, name in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    worded = has_words(names[text])
    joined = _with_class(plain.where(worded).withColumn("key", _key(names[text])), by_key)
    kept = joined.where((F.col("node") == F.col("head")) & F.col(names[doc_id]).eqNullSafe(F.col("class_id")))
    # Only a text of several rows can be there twice: all others are not moved again.
    whole = F.struct(*names.values())
    once = kept.where("copies > 1").groupBy("key").agg(
        F.min_by(whole, F.to_json(whole, {"ignoreNullFields": "false"})).alias("row")
    )
    single = kept.where("copies = 1").select(*names.values())
    left = plain.where(~worded).unionByName(single).unionByName(once.select("row.*"))
    return left.select(*[F.col(short).alias(name) for name, short in names.items()])
