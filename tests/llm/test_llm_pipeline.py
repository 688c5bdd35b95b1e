"""The pipeline's rows against the five stages written plainly, and the token files' skipping."""

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbwise.llm import pii, token_files, toxicity
from curbwise.llm.batches import table
from curbwise.session import staged_path

from test_llm_models import SMALL, bags, overlap
from test_llm_rules import plain_hits

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def one_of_each_group(docs):
    """The least id of each component of texts that overlap by 0.8 or more."""
    every = bags([text for _, text in docs])
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and every[i] and every[j] and overlap(every[i], every[j]) >= 0.8:
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        root = find(i) if every[i] else ("alone", i)
        least[root] = min(least.get(root, doc_id), doc_id)
    return [doc for doc in docs if doc[0] in set(least.values())]


def test_rows_equal_the_plain_stages(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    whole = table(spark, SMALL, "documents")
    model = toxicity.fit(whole, table(spark, SMALL, "labels"))
    # The score itself is held against its plain statement elsewhere.
    toxic = {r.doc_id for r in toxicity.score(whole, model).where("predicted = 1").collect()}
    left = [doc for doc in docs if doc[0] not in toxic]
    left = one_of_each_group(left)
    items = [(r.item_id, r.text) for r in table(spark, SMALL, "benchmark").collect()]
    left = [doc for doc in left if not plain_hits(doc[1] or "", items)[1]]
    expected = {}
    for doc_id, text in left:
        ids = LIBRARY.encode(pii.redact_text(text or "", pii.find_spans(text or "")[1]), add_special_tokens=False).ids
        expected[doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
    rows = corpus_pipeline.run(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256").collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256) for r in rows} == expected
    assert 0 < len(expected) < len(docs)


def test_redaction_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.co now", "s", "r", 9), (2, None, "s", "r", 0)], "doc_id long, text string, spans string, raw string, n_chars int"
    )
    rows = sorted(map(tuple, corpus_pipeline.redact_personal_data(spark, docs, SMALL).collect()))
    assert rows == [(1, "mail [EMAIL] now", "s", "r", 16), (2, "", "s", "r", 0)]


def rows_read(df):
    """Rows that the scan of a plan handed on."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().get("numOutputRows").get().value()


def test_token_files_skip_by_index_and_bloom_filter(spark):
    docs = spark.range(0, 60_000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    path = staged_path(spark, "tokens")
    token_files.write_tokens(docs.coalesce(1), path, PATH)
    tokens = token_files.read_tokens(spark, path).select("doc_id")
    assert rows_read(tokens) == 30_000
    assert rows_read(tokens.where("doc_id = 70001")) == 0  # outside of every file's range
    assert 0 < rows_read(tokens.where("doc_id = 12346")) < 30_000  # other row groups are skipped
    # Odd ids lie within the ranges: only the Bloom filter knows that they are not there.
    missing = [rows_read(tokens.where(f"doc_id = {odd}")) for odd in (10_001, 20_003, 30_005, 44_441)]
    assert Counter(missing)[0] >= 3
