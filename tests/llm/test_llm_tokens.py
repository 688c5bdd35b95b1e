"""Operators 1 and 2 against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbwise.llm import bpe, library, token_files
from curbwise.session import staged_path

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
OWN = bpe.WordBpe(open(PATH, "rb").read())
MEMO = library.LibraryEncoder(open(PATH, "rb").read())


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


CASES = ["", " ", "It's 12.5% \u00c9T\u00c9!!! don't", "<|endoftext|>a<|startoftext|>", "\u03a3\u03a3 e\u0301 \u0130x \u3000y", "a" * 3000, "..,a.,b,.", "x\x85y\u2028z\r\nq"]


def test_own_encoder_equals_the_library():
    for text in CASES:
        ids = OWN.encode_all([text])
        assert ids.to_pylist()[0] == expected(text), text
        assert OWN.decode_all(ids).to_pylist()[0] == LIBRARY.decode(expected(text), skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(max_codepoint=0x52F, exclude_categories=["Cs"]), max_size=60))
def test_both_encoders_on_any_text(text):
    assert OWN.encode_all([text]).to_pylist()[0] == expected(text)
    assert MEMO.encode_all(pa.array([text]), [2]).to_pylist()[0] == [*expected(text), 2]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from(" .,\n\u0130aE'"), st.characters(exclude_categories=["Cs", "Cn"])
), max_size=40), max_size=8))
def test_library_by_units_on_any_texts(texts):
    assert MEMO.encode_all(pa.array(texts, pa.string()), [2]).to_pylist() == [[*expected(text), 2] for text in texts]


def test_library_by_units_on_letters_that_grow():
    texts = ["\u0130.", "D\u0130, x", "TAK\u0130, x", "\u0130,\u0130.", "\ufb01, \u1e9e.", "<|endoftext|> a<|endoftext|>.", None]
    assert MEMO.encode_all(pa.array(texts, pa.string()), [2]).to_pylist() == [[*expected(text), 2] for text in texts]
    assert "\u0130" not in library.PLAIN and "\u00e9" in library.PLAIN


def test_heap_and_scan_merge_alike():
    word = "thequickbrownfoxjumpsoverthelazydog" * 5
    spelled = word + "</w>"
    start = [*range(len(word)), len(spelled)]
    assert bpe.merge_by_scan(spelled, list(start), OWN.ranks) == bpe.merge_by_heap(spelled, list(start), OWN.ranks)


def test_unknown_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([([256, -1, 999999],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(df, PATH).collect()] == ["!</w>", "", ""]


def test_odd_rows(odd_docs, no_docs):
    rows = bpe.round_trip(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert row.ids == expected(row.text)
    assert bpe.encode(no_docs, PATH).count() == 0


def test_token_files(spark, odd_docs, no_docs):
    path = staged_path(spark, "tokens")
    token_files.write_tokens(odd_docs, path, PATH)
    rows = sorted(token_files.token_positions(token_files.read_tokens(spark, path)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows][:4] == [None, None, 1, 2]
    at = 0
    for row in rows:
        assert row.start == at
        at += row.n_tokens
    by_id = {r.doc_id: r.text for r in odd_docs.collect() if r.doc_id}
    for row in rows:
        if row.doc_id:
            ids = np.array([*expected(by_id[row.doc_id]), 2], "<u4")
            assert (row.n_tokens, row.ids_crc32) == (len(ids), zlib.crc32(ids.tobytes()))
    filtered = token_files.read_tokens(spark, path).where(F.col("doc_id") == 3)
    assert "EqualTo(doc_id,3)" in filtered._jdf.queryExecution().toString() and filtered.count() == 1
    empty = staged_path(spark, "tokens")
    token_files.write_tokens(no_docs, empty, PATH)
    assert token_files.token_positions(token_files.read_tokens(spark, empty)).count() == 0
