"""Raw documents to token ids: five stages, each one operator of ``curbwise.llm``.

Every stage takes what its predecessor kept, and its result is written to the
shared folder and read again before the next one starts.

Defined results: null texts pass as empty ones until they are redacted, which
gives the empty text; null ids stay null; repeated rows of one id and text are
one document to near-dedup; extra columns of any name pass through all stages
but the last; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbwise.llm import bpe, decontaminate, near_dups, pii, toxicity
from curbwise.llm.batches import numbered, stage, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return toxicity.harmless(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dups.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and secrets replaced by the name of their kind and ``n_chars`` counted anew.

    Columns are numbered meanwhile, so none of any name clashes with those of the operator.
    """
    plain, names = numbered(docs)
    found = pii.detect(plain, names["text"], redacted="clean")
    counted = F.length("clean")

    def column(name: str):
        if name == "text":
            return F.col("clean").alias(name)
        if name == "n_chars":
            return counted.cast(docs.schema[name].dataType).alias(name)
        return F.col(names[name]).alias(name)

    return found.select(*map(column, docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with their number and hashes of the ids and of the decoded text."""
    encoded = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), VOCABULARY, drop=("text",))
    return encoded.select(
        "doc_id", "lang", "source", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("encoding", encode),
]

#: The toxicity model, the signatures and the encoder have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
