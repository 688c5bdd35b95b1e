"""The thirteen registered queries, each its operator over its whole table, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.llm import (
    alignment, bpe, decontaminate, languages, licenses, near_dups, oracles, packing, periodic_runs, pii, quality,
    token_files, toxicity, urls,
)
from curbwise.llm.batches import fold, table
from curbwise.session import stage, staged_path

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return token_digest(bpe.round_trip(docs, VOCABULARY, drop=("text",)))


def token_digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = staged_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf, "documents"), path, VOCABULARY)
    return token_files.token_positions(token_files.read_tokens(spark, path))


def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    counted = stage(quality.with_counts(docs), "quality-counts")
    return quality.judge(docs, counted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *quality.MEASURES, *[f"max_{m}" for m in quality.MEASURES],
    )


def op4_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf, "documents").select("doc_id", "text"), drop=("text",)))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return decontaminate.summary(decontaminate.scan(docs, table(spark, sf, "benchmark")))


def op6_near_dups(spark: SparkSession, sf: str) -> DataFrame:
    return near_dups.classes(table(spark, sf, "documents"))


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_words", "evidence"
    )


def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", F.size("strict_terms").cast("bigint").alias("n_strict"),
        F.size("soft_terms").cast("bigint").alias("n_soft"),
    )


def op9_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return languages.identify(docs, languages.fit(docs)).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = licenses.scan(docs, drop=("text",))
    return found.select(
        "doc_id", F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.array_max("matches.containment").alias("best_containment"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(
            ":", m["license"], m["first_word"].cast("string"), m["end_word"].cast("string")
        )), ",").alias("spans"),
    )


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    parts = packing.segments(table(spark, sf, "documents"), VOCABULARY)
    return packing.pieces(parts, packing.place(parts))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.summary(alignment.runs(table(spark, sf, "documents"), BYTE_LEVEL, PIECES))


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = periodic_runs.find(docs, rewrite=("doc_id", periodic_runs.planted), drop=("text",))
    return periodic_runs.digest(found)


def _pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_bpe, op2_token_files, op3_quality, op4_pii, op5_decontamination, op6_near_dups, op7_toxicity,
        op8_url_filter, op9_language_id, op10_licenses, op11_packing, op12_alignment, op13_periodic_runs,
    )
} | {"pipeline": _pipeline}

ORACLES: dict[str, str] = {
    "op3_quality": oracles.QUALITY,
    "op5_decontamination": oracles.DECONTAMINATION,
    "op6_near_dups": oracles.NEAR_DUPS,
    "op8_url_filter": oracles.URLS,
}
