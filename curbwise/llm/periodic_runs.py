"""Operator 13: runs of repeated words, from Lyndon arrays by Baier's grouping.

A run is a longest stretch of words that repeats with its smallest period. Every
run has a Lyndon root under one of the two orders of the words, the usual one or
its reverse: the longest Lyndon word that starts at some place in it. So for
both orders:

- The first phase of Baier's suffix sorter groups the suffixes by their first
  word and takes the groups from the greatest down. Each suffix of a group is
  handed to the nearest place before it that is in a lower group, which grows by
  the group's context as often as it gets one; places of a group that grew alike
  form a new group just above their old one. The contexts that are left are the
  longest Lyndon words, so no suffix array is built.
- Roots of equal length that follow one another are one chain; its first root is
  extended to both sides while the words one period on are equal (LCE, by
  comparing blocks that double), and kept where it is long enough.

Words that occur fewer times in a stretch than a run has periods cannot be in
it. They cut a text into stretches, which are cut again until nothing
changes; that finds the same runs and spares most texts the grouping.

Everything happens inside a text, so there is no shuffle, and frequent sources or
texts do no harm. Time and memory grow with a text's length, up to logarithms.

Defined results: null, empty and blank texts have no words and no runs; repeated
rows get their own result each; an empty table gives no rows; columns named as
the added ones are replaced, other extra columns pass through.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections import Counter
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4

Run = tuple[int, int, int]


def lyndon_array(ranks: list[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place, by Baier's first phase."""
    n = len(ranks)
    context = [1] * n
    # Groups are numbered; ``below`` is the next lower one, ``members`` ascending places (some may have left).
    buckets: dict[int, list[int]] = {}
    for place, rank in enumerate(ranks):
        buckets.setdefault(rank, []).append(place)
    ordered = sorted(buckets)
    number = {rank: at for at, rank in enumerate(ordered)}
    group = [number[rank] for rank in ranks]
    members = [buckets[rank] for rank in ordered]
    below = list(range(-1, len(ordered) - 1))
    above = [*range(1, len(ordered)), -1]
    # The nearest place at or before each that is not done, with halved paths; place p is kept at p + 1.
    left = list(range(n + 1))
    current = len(ordered) - 1
    while current >= 0:
        here = [place for place in members[current] if group[place] == current]
        members[current] = ()
        if here:
            size = context[here[0]]
            for place in here:
                left[place + 1] = place
            # How many of the group each lower place gets; the places come in ascending order.
            gets: list[tuple[int, int]] = []
            last, many = 0, 0
            for place in here:
                at = place
                while left[at] != at:
                    left[at] = at = left[left[at]]
                left[place + 1] = at
                if at == last:
                    many += 1
                else:
                    if last:
                        gets.append((many, last - 1))
                    last, many = at, 1
            if last:
                gets.append((many, last - 1))
            # The more contexts a place gets, the higher its new group; each goes just above the old one.
            fresh: dict[tuple[int, int], int] = {}
            gets.sort(key=lambda each: (-each[0], each[1]))
            for many, place in gets:
                old = group[place]
                new = fresh.get((many, old))
                if new is None:
                    new = fresh[many, old] = len(members)
                    members.append([])
                    upper = above[old]
                    above.append(upper)
                    below.append(old)
                    above[old] = new
                    if upper >= 0:
                        below[upper] = new
                members[new].append(place)
                group[place] = new
                context[place] += many * size
        current = below[current]
    return context


def lce_right(data: memoryview, i: int, j: int) -> int:
    """How many words from ``i`` on equal those from ``j`` on, ``j`` being the later one."""
    n, total, block = len(data), 0, 16
    while j + total < n:
        size = min(block, n - j - total)
        if data[i + total:i + total + size] == data[j + total:j + total + size]:
            total, block = total + size, 2 * block
        elif size == 1:
            break
        else:
            block = size // 2
    return total


def lce_left(data: memoryview, i: int, j: int) -> int:
    """How many words before ``i`` equal those before ``j``, ``i`` being the earlier one."""
    total, block = 0, 16
    while i - total > 0:
        size = min(block, i - total)
        if data[i - total - size:i - total] == data[j - total - size:j - total]:
            total, block = total + size, 2 * block
        elif size == 1:
            break
        else:
            block = size // 2
    return total


def runs_of_stretch(words: list[bytes], least_words: int, least_periods: int) -> set[Run]:
    """(start, length, period) of the runs that are long enough."""
    distinct = sorted(set(words))
    number = {word: at for at, word in enumerate(distinct)}
    ranks = [number[word] for word in words]
    data = memoryview(array("q", ranks)).cast("B").cast("q")
    found: set[Run] = set()
    n = len(words)
    for keys in (ranks, [len(distinct) - rank for rank in ranks]):
        lyndon = lyndon_array(keys)
        ends: dict[int, int] = {}
        for i, period in enumerate(lyndon):
            # A run of k periods has k - 1 roots in a row, of which this is the first.
            last = i + (least_periods - 2) * period
            if last + period > n or ends.get(period, 0) >= i + period:
                continue
            if any(lyndon[at] != period for at in range(i + period, last + 1, period)):
                continue
            start = i - lce_left(data, i, i + period)
            end = i + period + lce_right(data, i, i + period)
            if end - start >= 2 * period:
                ends[period] = end
            if end - start >= max(least_words, least_periods * period):
                found.add((start, end - start, period))
    return found


def text_runs(words: list[bytes], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[Run]:
    """All runs of a text by start and period."""
    found: list[Run] = []
    open_ = [(0, words)]
    while open_:
        at, stretch = open_.pop()
        if len(stretch) < least_words:
            continue
        often = {word for word, n in Counter(stretch).items() if n >= least_periods}
        if not often:
            continue
        parts, place = [], 0
        for kept, rows in groupby(stretch, often.__contains__):
            rows = list(rows)
            if kept and len(rows) >= least_words:
                parts.append((at + place, rows))
            place += len(rows)
        if len(parts) == 1 and len(parts[0][1]) == len(stretch):
            found += [(at + a, n, p) for a, n, p in runs_of_stretch(stretch, least_words, least_periods)]
        else:
            open_ += parts
    return sorted(found, key=lambda run: (run[0], run[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period; ties go to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without what a run repeats after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for start, end in sorted((start + period, start + length) for start, length, period in runs):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return kept + words[at:]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find(
    docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS,
    rewrite: tuple[str, object] | None = None, drop: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with ``runs`` and the ``collapsed`` text, its words joined by one space. No shuffle.

    ``rewrite`` (column, function) may change the words before they are looked
    at: the function gets the column's value and the words.
    """
    ship_package(docs.sparkSession)
    if least_periods < 3 or least_words < 1:
        raise ValueError("runs are looked for from three periods on")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def make():
        def compute(part: pa.RecordBatch) -> list:
            every, left = [], []
            values = part.column(text).cast(pa.binary()).to_pylist()
            keys = part.column(rewrite[0]).to_pylist() if rewrite else [None] * len(values)
            for value, key in zip(values, keys, strict=True):
                # bytes.split() cuts at the space and at 0x09 to 0x0D.
                words = (value or b"").split()
                if rewrite:
                    words = rewrite[1](key, words)
                runs = text_runs(words, least_words, least_periods)
                every.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in runs])
                left.append(b" ".join(collapsed(words, runs)))
            return [pa.array(every, kind), pa.array(left, pa.binary()).cast(pa.string())]

        return compute

    return arrow_pass(docs, f"runs {RUNS}, collapsed string", make, drop)


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with the repetition that the id of one document in ten asks for; a null id leaves them."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the strongest of them, and hashes of the runs and the text without repetition."""
    runs = F.col("runs")

    def stronger(best, run):
        wins = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(wins, run).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    written = F.transform(runs, lambda run: F.concat(F.concat_ws(",", run["start"], run["length"], run["period"]), F.lit("\n")))
    best = found.withColumn("best", F.aggregate(runs, none, stronger))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
