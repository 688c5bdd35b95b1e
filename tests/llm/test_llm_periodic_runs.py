"""Operator 13 against definitions tried at every place."""

import hashlib
import random
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from curbwise.llm import periodic_runs
from curbwise.llm.queries import op13_periodic_runs

SMALL = "/root/testdata/sf0.001"


def plain_lyndon(word):
    starts = range(len(word))
    lyndon = lambda w: all(w < w[k:] for k in range(1, len(w)))
    return [max(j - i for j in range(i + 1, len(word) + 1) if lyndon(word[i:j])) for i in starts]


def plain_runs(words, least_words=6, least_periods=4):
    n, found = len(words), []
    for p in range(1, n):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            size = j + p - i
            if j > i and size >= max(least_words, least_periods * p):
                run = words[i:i + size]
                if not any(run[q:] == run[:-q] for q in range(1, p)):
                    found.append((i, size, p))
            i = max(j, i + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=18))
def test_lyndon_array(word):
    assert periodic_runs.lyndon_array(word) == plain_lyndon(word)


blocks = st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c", b"dd"]), min_size=1, max_size=6), st.integers(1, 6)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(blocks, st.integers(0, 4))
def test_runs(parts, cut):
    words = [word for part, times in parts for word in part * times]
    words = words[:len(words) - cut]
    assert periodic_runs.text_runs(words) == plain_runs(words)
    assert periodic_runs.text_runs(words, 1, 3) == plain_runs(words, 1, 3)


def test_extension_compares_whole_words():
    words = [b"ab", b"a", b"b"] * 5 + [b"ab", b"a", b"c"]
    assert periodic_runs.text_runs(words) == [(0, 17, 3)]
    kept = periodic_runs.collapsed(words, [(0, 17, 3)])
    assert kept == [b"ab", b"a", b"b", b"c"]


def test_strongest_is_exact_and_takes_the_first_of_equals():
    assert periodic_runs.strongest([(0, 13, 3), (20, 26, 6), (60, 9, 2)]) == (60, 9, 2)
    assert periodic_runs.strongest([(0, 12, 3), (20, 24, 6)]) == (0, 12, 3)
    assert periodic_runs.strongest([]) is None


def test_long_repetitive_texts():
    ab = [b"a", b"b"]
    assert periodic_runs.text_runs(ab * 20_000) == [(0, 40_000, 2)]
    assert periodic_runs.text_runs([b"a"] * 30_000) == [(0, 30_000, 1)]
    rng = random.Random(1)
    block = [str(rng.randrange(9999)).encode() for _ in range(5_000)]
    assert (0, 20_000, 5_000) in periodic_runs.text_runs(block * 4)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    dropped = {i for start, size, period in found for i in range(start + period, start + size)}
    best = periodic_runs.strongest(found)
    return (
        doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join("%d,%d,%d\n" % run for run in found).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_small_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    texts = {r.doc_id: r.text for r in docs}
    rows = op13_periodic_runs(spark, SMALL).collect()
    assert len(rows) == len(docs) and sum(r.n_runs for r in rows) > 0
    for row in rows:
        if len(texts[row.doc_id].split()) <= 250:
            assert tuple(row) == expected(row.doc_id, texts[row.doc_id])


def test_odd_rows(odd_docs, no_docs):
    def query(docs):
        found = periodic_runs.find(docs, rewrite=("doc_id", periodic_runs.planted))
        assert set(docs.columns) <= set(found.columns) and len(set(found.columns)) == len(found.columns)
        return periodic_runs.digest(found)

    rows = query(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: tuple(r) for r in rows}
    for r in odd_docs.collect():
        if r.doc_id is not None and len((r.text or "").split()) < 500:
            assert by_id[r.doc_id] == expected(r.doc_id, r.text)
    assert query(no_docs).count() == 0
