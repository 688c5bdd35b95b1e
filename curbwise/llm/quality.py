"""Operator 3: quality rules with thresholds learned per language and source.

Each document gets a few whole numbers (shares in thousandths). Their
distributions per (language, source) are kept as log-linear histograms: a
quantile sketch whose merge is the addition of counts, so partial aggregation,
retries and any order of merging give the same bits, and the relative error of
a quantile is below 1/16. Sketches of sources merge into one per language, and
those into one for everything; a document is judged by the narrowest group
with at least ``MIN_GROUP`` documents that pass the base rules.

An upper fence is the upper quartile plus ``SPREAD`` interquartile ranges, and
at least ``SLACK`` above the quartile, so that a group without any variation
does not reject its first odd document.

Defined results: null and empty texts have no words and fail the base rules;
null languages and sources are groups of their own.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbwise.llm.batches import arrow_pass, ship_package, stage

SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
MIN_GROUP = 50
SPREAD = 3
#: Least distance of a fence from the quartile, per measure.
SLACK = {"symbols_pm": 100, "dup_lines_pm": 200, "repeats_pm": 200, "word_length_pm": 2000}
MEASURES = tuple(SLACK)
COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total, covered = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + 3 - max(covered, at)
            covered = at + 3
    return total


def text_counts(data: bytes) -> tuple[int, int, int, int, int, int]:
    """The base counts of one UTF-8 text, then its lines that hold a word."""
    words = data.split()  # on bytes: exactly the six ASCII white spaces
    # Continuation bytes are no code points of their own.
    chars = sum(map(len, words)) - (0 if data.isascii() else len(data) - len(data.translate(None, CONTINUATION)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with its base counts and ``n_lines``."""
    ship_package(docs.sparkSession)

    def make():
        def compute(part: pa.RecordBatch) -> list:
            data = part.column(text).cast(pa.binary()).to_pylist()
            return [pa.array(column, pa.int64()) for column in zip(*(text_counts(d or b"") for d in data), strict=True)]

        return compute

    return arrow_pass(docs, f"{COUNTS}, n_lines bigint", make, drop=(text,))


def with_measures(counted: DataFrame) -> DataFrame:
    share = lambda part, whole, scale=1000: F.expr(f"coalesce({part} * {scale} div nullif({whole}, 0), 0)")
    return counted.withColumns({
        "symbols_pm": share("n_symbols", "n_words"),
        "dup_lines_pm": share("n_dup_lines", "n_lines"),
        "repeats_pm": share("n_repeat_words", "n_words"),
        "word_length_pm": share("word_chars", "n_words"),
        "base_failed": F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"),
    })


#: Groups (language, source) up to which their limits are broadcast (some 100 bytes each).
BROADCAST_GROUPS = 100_000


def bucket(value: Column) -> Column:
    """Lower bound of the value's bucket: exact below 32, then 16 buckets for each doubling."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def sketches(measured: DataFrame) -> DataFrame:
    """Histogram rows (lang, source, measure, bucket, n) over documents that pass the base rules."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(F.col(name)).alias("bucket")) for name in MEASURES
    ]))
    rows = measured.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
    return rows.groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count(F.lit(1)).alias("n"))


def fences(histogram: DataFrame) -> DataFrame:
    """Per (lang, source) the widest group's or its own upper fence of each measure.

    The histogram has a bounded number of buckets per group, so what is summed
    here is small however many documents it stands for.
    """
    groups = histogram.select("lang", "source").distinct()
    levels = {
        "own": ["lang", "source"], "lang": ["lang"], "all": [],
    }
    out = groups
    for level, keys in levels.items():
        merged = histogram.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
        listed = merged.groupBy(*keys, "measure").agg(
            F.sum("n").alias("total"),
            F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("buckets"),
        )
        limits = listed.select(*keys, "measure", "total", _fence(F.col("measure")).alias("fence"))
        wide = limits.groupBy(*keys).agg(
            F.max("total").alias(f"{level}_n"),
            *[F.max(F.when(F.col("measure") == m, F.col("fence"))).alias(f"{level}_{m}") for m in MEASURES],
        )
        if not keys:
            out = out.withColumn("whole", wide.select(F.struct("*")).scalar()).select("*", "whole.*").drop("whole")
            continue
        for key in keys:
            wide = wide.withColumnRenamed(key, f"{level}_{key}")
        out = out.join(wide, [F.col(key).eqNullSafe(F.col(f"{level}_{key}")) for key in keys], "left")
        out = out.drop(*[f"{level}_{key}" for key in keys])
    return out.select("lang", "source", *[
        F.when(F.col("own_n") >= MIN_GROUP, F.col(f"own_{m}"))
        .when(F.col("lang_n") >= MIN_GROUP, F.col(f"lang_{m}")).otherwise(F.col(f"all_{m}")).alias(f"max_{m}")
        for m in MEASURES
    ])


def _quantile(quarter: int) -> Column:
    """The bucket in which the running count first reaches quarter / 4 of the total."""
    return F.expr(f"""aggregate(buckets, named_struct('seen', 0L, 'at', CAST(NULL AS BIGINT)),
        (s, b) -> named_struct('seen', s.seen + b.n,
                               'at', coalesce(s.at, if(4 * (s.seen + b.n) >= {quarter} * total, b.bucket, NULL))),
        s -> s.at)""")


def _fence(measure: Column) -> Column:
    low, high = _quantile(1), _quantile(3)
    slack = F.coalesce(*[F.when(measure == name, F.lit(SLACK[name]).cast("bigint")) for name in MEASURES])
    return high + F.greatest(SPREAD * (high - low), slack)


def judge(docs: DataFrame, counted: DataFrame | None = None) -> DataFrame:
    """doc_id, base counts, measures, fences, ``base_failed`` and ``kept``.

    ``counted`` may be a staged result of ``with_counts``, so that the texts
    are read once for the sketches and the verdicts.
    """
    source = with_counts(docs.select("doc_id", "lang", "source", "text")) if counted is None else counted
    measured = with_measures(source)
    limits = stage(fences(sketches(measured)).select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), *[f"max_{m}" for m in MEASURES]
    ), "quality-fences")
    # A handful of groups holds all documents: their limits are broadcast, so that no group is one task's.
    if limits.count() <= BROADCAST_GROUPS:
        limits = F.broadcast(limits)
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")), "left"
    ).drop("g_lang", "g_source")
    # A group whose documents all fail the base rules has no fence, and nothing left to judge.
    inside = [F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True)) for m in MEASURES]
    verdict = ~F.col("base_failed")
    for each in inside:
        verdict = verdict & each
    return joined.withColumn("kept", verdict)
