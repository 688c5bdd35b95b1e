"""Operator 11: plans against their rules, pieces against the tokenizers library."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbwise.llm import packing
from curbwise.llm.queries import op11_packing

SMALL = "/root/testdata/sf0.001"

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


def best_sum(room, lengths):
    sums = {0}
    for length in lengths:
        sums |= {s + length for s in sums if s + length <= room}
    return max(sums)


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 60), st.lists(st.integers(1, 40), max_size=14))
def test_closest_fill_is_the_best_subset_sum(room, lengths):
    left = Counter(lengths)
    slack, used = packing.closest_fill(room, left, sorted(left, reverse=True))
    assert room - slack == sum(length * many for length, many in used.items()) == best_sum(room, lengths)
    assert all(many <= left[length] for length, many in used.items())


def check_plan(counts, capacity):
    lookup = packing.Lookup(packing.Plan(dict(counts), capacity).rows)
    length = np.repeat(np.array(list(counts), np.int64), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    many, given_, tokens, window, offset = lookup.find(length, rank)
    owner = np.repeat(np.arange(len(length)), many)
    at = np.zeros(len(length), np.int64)
    for i in np.lexsort([given_, owner]):  # the pieces of a segment follow one another
        assert given_[i] == at[owner[i]]
        at[owner[i]] += tokens[i]
    assert (at == length).all()
    filled = defaultdict(int)
    for i in np.lexsort([offset, window]):  # and so do those of a window
        assert offset[i] == filled[window[i]]
        filled[window[i]] += tokens[i]
    assert sorted(filled) == list(range(len(filled)))
    short = [size for size in filled.values() if size != capacity]
    assert all(size < capacity and size & (size - 1) == 0 for size in short) and len(set(short)) == len(short)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1, max_size=20))
def test_every_plan_is_whole_and_nothing_is_padded(counts):
    check_plan(counts, 64)


@pytest.mark.parametrize("counts", [{3000: 999}, {1: 9000}, {4096: 5}, {4095: 3, 2: 2}, {2048: 7, 1: 1}])
def test_one_length_for_all(counts):
    check_plan(counts, 4096)


def test_plan_does_not_grow_with_the_rows():
    counts = {length: 50 + length % 7 for length in range(1, 4097, 3)}
    small = len(packing.Plan(dict(counts)).rows)
    large = len(packing.Plan({length: n * 100_000 for length, n in counts.items()}).rows)
    assert large < 2 * small


def check_pieces(rows, texts):
    """``texts`` has (doc_id, text), ids being unique where they are not null."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in rows:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    for doc_id, text in texts:
        ids, at = np.array(ids_of(text), "<u4"), 0
        for row in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(ids[at:at + row.length].tobytes())
            at += row.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at == 4096 or at < 4096 and at & (at - 1) == 0


def test_pieces_of_the_small_table(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(op11_packing(spark, SMALL).collect(), texts)


def test_sequences_hold_the_ids(spark):
    long_text = " ".join(f"w{i}" for i in range(4000))
    docs = spark.createDataFrame([(1, long_text), (2, "a b c"), (3, None), (4, long_text[::-1])], "doc_id long, text string")
    parts = packing.segments(docs, PATH)
    rows = packing.sequences(parts, packing.place(parts)).collect()
    texts = {r.doc_id: ids_of(r.text) for r in docs.collect()}
    seen = Counter()
    for row in rows:
        assert len(row.ids) == 4096 or len(row.ids) & (len(row.ids) - 1) == 0
        for each in row.documents:
            assert row.ids[each.offset:each.offset + each.length] == texts[each.doc_id][each.start:each.start + each.length]
            seen[each.doc_id] += each.length
    assert seen == {doc_id: len(ids) for doc_id, ids in texts.items()}


def test_odd_rows(odd_docs, no_docs):
    parts = packing.segments(odd_docs, PATH)
    rows = packing.pieces(parts, packing.place(parts)).collect()
    expected = Counter()
    for r in odd_docs.collect():
        expected[r.doc_id] += len(ids_of(r.text))
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == expected
    empty = packing.segments(no_docs, PATH)
    assert packing.pieces(empty, packing.place(empty)).count() == 0
    assert packing.sequences(empty, packing.place(empty)).count() == 0
