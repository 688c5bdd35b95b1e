"""Operator 12 against both libraries on whole texts and a plain count of all links."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from curbwise.llm import alignment
from curbwise.llm.bpe import byte_symbols
from curbwise.llm.queries import BYTE_LEVEL, PIECES, op12_alignment

SMALL = "/root/testdata/sf0.001"

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
VALUES = {symbol: value for value, symbol in enumerate(byte_symbols())}
A_BYTES = {i: bytes(VALUES[c] for c in t) if set(t) <= set(VALUES) else t.encode() for t, i in A.get_vocab().items()}
OWN = alignment.Aligner(open(BYTE_LEVEL, "rb").read(), open(PIECES, "rb").read())


def b_bytes(number):
    name = B.id_to_piece(number)
    return bytes([int(name[1:-1], 16)]) if B.is_byte(number) else name.replace("▁", " ").encode()


def plain(text):
    """(n_a, n_b, n_groups), the groups and the links."""
    none = ((0, 0, 0), None, [])
    if not text:
        return none
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(map(A_BYTES.get, a)) != whole or b"".join(map(b_bytes, b)) != whole:
        return none
    sides = ([len(A_BYTES[each]) for each in a], [len(b_bytes(each)) for each in b])
    ends = [{end: place + 1 for place, end in enumerate(np.cumsum(side).tolist())} for side in sides]
    at, groups, links = (0, 0), [], []
    for end in sorted(set(ends[0]) & set(ends[1])):
        to = ends[0][end], ends[1][end]
        groups.append(",".join(map(str, a[at[0]:to[0]])) + "|" + ",".join(map(str, b[at[1]:to[1]])))
        links.append((a[to[0] - 1], b[to[1] - 1]))
        at = to
    return (len(a), len(b), len(groups)), ";".join(groups), links


def check(texts):
    counts, groups, links = OWN.texts(pa.array(texts, pa.string()))
    at = 0
    for text, got, written in zip(texts, counts.tolist(), groups.to_pylist(), strict=True):
        expected = plain(text)
        assert (tuple(got), written) == expected[:2], text
        codes = alignment.pair_code(*[np.array([link[side] for link in expected[2]], np.int64) for side in (0, 1)])
        assert links[at:at + got[2]].tolist() == codes.tolist()
        at += got[2]


def test_spaces_marks_and_special_tokens():
    check([
        "hello world.", "", None, " ", "  ", " a", "a ", "a  b", "\n", "a\n b", "a \nb", "x.\ny.", "x\n\ny", "▁", "a ▁ b",
        "<|endoftext|> a<|endoftext|>b", "\x01 a\x01\x02 \x02b\x03", "don't 12,5", "</s><unk> <0x41>", "a　b 　c", "İ. x",
    ])
    check([])
    check([None])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(
    st.sampled_from(" .,\né"), st.characters(max_codepoint=0x2600, exclude_categories=["Cs"])
), max_size=50), max_size=6))
def test_any_texts(texts):
    check(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.dictionaries(st.integers(0, 50), st.integers(1, 9), min_size=1), min_size=1, max_size=9))
def test_merged_runs_add_up(runs):
    blocks = []
    for run in runs:
        pairs = np.array(sorted(run), np.int64)
        blocks.append(alignment.pack_pairs(pairs, np.array([run[p] for p in sorted(run)], np.int64)))
    assert list(alignment.merged(blocks)) == sorted(sum(map(Counter, runs), Counter()).items())


def expected_rows(texts):
    found = [plain(text) for _, text in texts]
    counts = Counter(link for each in found for link in each[2])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for (doc_id, _), (sizes, groups, links) in zip(texts, found, strict=True):
        rows.append((
            doc_id, *sizes, len(links), sum(counts[link] == most[link[1]] for link in links), sum(counts[link] for link in links),
            hashlib.sha256(groups.encode()).hexdigest() if groups is not None else "",
        ))
    return Counter(rows), counts


@pytest.mark.parametrize("fan", [2, 64])
def test_small_table(spark, monkeypatch, fan):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected, counts = expected_rows(texts)
    if fan == 64:
        assert Counter(map(tuple, op12_alignment(spark, SMALL).collect())) == expected
        return
    # Many small runs, merged two at a time over several levels.
    runs = alignment.runs(docs.repartition(7), BYTE_LEVEL, PIECES)
    assert runs.count() >= 4
    assert Counter(map(tuple, alignment.summary(runs, fan=fan).collect())) == expected
    assert {(r.a, r.b): r["count"] for r in alignment.pair_counts(runs).collect()} == counts


def test_odd_rows(odd_docs, no_docs):
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows = alignment.summary(alignment.runs(odd_docs, BYTE_LEVEL, PIECES)).collect()
    assert Counter(map(tuple, rows)) == expected_rows(texts)[0]
    assert alignment.summary(alignment.runs(no_docs, BYTE_LEVEL, PIECES)).count() == 0
