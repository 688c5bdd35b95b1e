"""Operators 6, 7 and 9 and the pipeline: brute force, held-out accuracy, odd rows."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from curbwise.llm import languages, near_dups, toxicity
from curbwise.llm.batches import fold, table, words_of
from curbwise.llm.components import components

SMALL = "/root/testdata/sf0.001"


def bags(texts):
    out = []
    for text in texts:
        words = (text or "").lower().split()
        size = min(5, len(words))
        out.append(Counter(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if words else Counter())
    return out


def overlap(a, b):
    shared = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - shared
    return shared / total if total else 0.0


def test_signatures_estimate_the_weighted_overlap():
    texts = ["a b c d e " * 30 + " ".join(f"x{i}" for i in range(n)) for n in (100, 120, 300)]
    shingler = near_dups.Shingler()
    own = [shingler(t) for t in texts]
    sigs = near_dups.signatures(own, 4000)
    plain = bags(texts)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        exact = overlap(plain[i], plain[j])
        assert abs(near_dups.similarity(own[i], own[j]) - exact) < 1e-12
        assert abs((sigs[i] == sigs[j]).mean() - exact) < 0.04


def plain_classes(rows):
    every = bags([r.text for r in rows])
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if every[i] and every[j] and overlap(every[i], every[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i].doc_id)
    return sorted((r.doc_id or -1, min((x for x in groups[find(i)] if x is not None), default=None) or -1) for i, r in enumerate(rows))


def test_classes_equal_brute_force(spark, odd_docs, no_docs):
    for docs in (odd_docs, table(spark, SMALL, "documents")):
        found = near_dups.classes(docs).collect()
        assert sorted((r.doc_id or -1, r.class_id or -1) for r in found) == plain_classes(docs.collect())
    kept = near_dups.representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 1, 4, 5, 6, 7, 8, 9]
    assert near_dups.classes(no_docs).count() == 0 and near_dups.representatives(no_docs).count() == 0


def test_marks_are_words_and_the_first_of_equal_rows_stays(spark):
    rows = [(3, "!!! ???", "b"), (2, "!!! ???", "z"), (2, "!!! ???", "a"), (5, " \u2003 ", "x"), (4, "", "x"), (1, None, "x"), (1, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    kept = sorted(map(tuple, near_dups.representatives(docs).collect()), key=str)
    assert kept == sorted([(2, "!!! ???", "a"), *rows[3:]], key=str)
    found = Counter(map(tuple, near_dups.classes(docs).collect()))
    assert found == Counter({(2, 2): 2, (3, 2): 1, (5, 5): 1, (4, 4): 1, (1, 1): 2})


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert set(found.values()) == {0, 100} and len(found) == 44


def test_toxicity(spark, odd_docs, no_docs, few_labels):
    clean, bad = [f"ordinary{i % 37} prose{i % 91} line{i % 53}" for i in range(400)], ["awful scum", "vile idiot"]
    rows = []
    for i in range(400):
        words = " ".join(clean[(i * 7 + k) % 400] for k in range(15))
        rows.append((i, words + (" " + bad[i % 2] + " x " + bad[(i // 2) % 2] if i % 3 == 0 else ""), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    wrong = toxicity.score(docs, model).join(docs, "doc_id").where("predicted != toxic AND crc32(CAST(doc_id AS STRING)) % 5 = 0")
    assert wrong.count() == 0
    scored = toxicity.score(odd_docs.select("doc_id", "text"), model).collect()
    assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.harmless(odd_docs, model).columns == odd_docs.columns
    tiny = toxicity.fit(odd_docs, few_labels)
    assert toxicity.score(odd_docs, tiny).count() == odd_docs.count()
    nothing = toxicity.fit(no_docs, few_labels)
    assert nothing == 0.0 and toxicity.harmless(no_docs, nothing).count() == 0


def test_a_rare_word_is_known_by_its_stem():
    left = np.array([[9.0, 9.0], [40.0, 5.0], [0.0, 0.0]])
    model = toxicity.Model(
        [b"plain", b"scumbag"], left, np.empty(0, np.int64), np.empty((0, 2)), ["plain", "scumb", "\u00e9t\u00e9"],
        np.array([[400.0, 50.0], [1.0, 30.0], [8.0, 1.0]]),
    )
    assert model.evidence([b"scumbaggery"]) > 0.01 and model.evidence([b"scumbag"]) > 0.01
    # Words that are relatively more frequent in ordinary text speak for it, a little.
    assert -0.02 < model.evidence(["\u00e9t\u00e9".encode()]) < 0 and -0.02 < model.evidence([b"plain"]) < 0
    assert model.evidence([b"neverseen"]) == model.evidence([]) == 0.0


def test_toxicity_without_rows_for_the_curve(spark):
    rows = [(i, "plain words here" + (" vile scum" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").where(fold(F.col("doc_id"), 5) > 1)
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    assert 0 < toxicity.harmless(docs, model).count() < docs.count()


def test_toxicity_counts_every_ngram(spark, monkeypatch):
    rows = []
    for i in range(300):
        words = [f"w{(i * 7 + k * k) % 211}" for k in range(20)] + ([f"scum{i % 9}", "vile"] if i % 3 == 0 else [])
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    texts = [(words_of(text.encode()), toxic) for _, text, toxic in rows]
    ones, twos = [Counter(), Counter()], [Counter(), Counter()]
    for words, toxic in texts:
        ones[toxic].update(words)
        twos[toxic].update(zip(words, words[1:]))
    both = ones[0] + ones[1]
    vocabulary = sorted(word for word in both if both[word] >= 3)
    place = {word: at + 1 for at, word in enumerate(vocabulary)}
    left = np.zeros((len(place) + 1, 2))
    for c in (0, 1):
        for _, second in twos[c]:
            left[place.get(second, 0), c] += 1
    pairs = sorted((place[a] * len(left) + place[b], twos[0][a, b], twos[1][a, b]) for a, b in twos[0] + twos[1]
                   if a in place and b in place and twos[0][a, b] + twos[1][a, b] >= 2)
    keys, counts = np.array([p[0] for p in pairs]), np.array([p[1:] for p in pairs], float)
    stems = sorted({word[:5].decode() for word in both})
    stem_counts = np.array([[sum(n for w, n in ones[c].items() if w[:5].decode() == s) for c in (0, 1)] for s in stems], float)
    plain = toxicity.Model(vocabulary, left, keys, counts, stems, stem_counts)
    evidence = toxicity.evidence_table(docs).cache()
    assert evidence.where("value = 0").count() == 0
    seen = []
    for local in (10**6, 60, 0):  # all broadcast, some joined, all joined
        monkeypatch.setattr(toxicity, "LOCAL", local)
        model = toxicity._split(evidence)
        assert (model.others.count() == 0) == (local == 10**6) and (len(model.keys) == 0) == (local == 0)
        found = toxicity.with_evidence(docs.select(F.col("doc_id").alias("doc"), "text"), model).collect()
        seen.append({r.doc: (r.evidence, r.n_words) for r in found})
        assert len(found) == len(rows)
    assert seen[0] == seen[1] == seen[2]
    for (doc, _, _), (words, _) in zip(rows, texts):
        assert abs(seen[0][doc][0] - plain.evidence(words)) < 1e-7 and seen[0][doc][1] == len(words)


def test_languages(spark, odd_docs, no_docs):
    docs = table(spark, "/root/testdata/sf0.01", "documents").withColumn("held", fold(F.col("doc_id"), 4) == 2)
    found = languages.identify(docs, languages.fit(docs)).join(docs, "doc_id").where("held").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.98
    odd = {r.doc_id: r for r in languages.identify(odd_docs, languages.fit(odd_docs)).collect()}
    assert odd[5].lang_pred == odd[7].lang_pred == "und" and odd[6].lang_pred == "en"
    assert {r.lang_pred for r in languages.identify(odd_docs, languages.fit(no_docs)).collect()} == {"und"}
    assert languages.identify(no_docs, languages.fit(no_docs)).count() == 0


def test_pipeline_stages(spark, odd_docs, no_docs):
    whole = table(spark, SMALL, "documents").unionByName(odd_docs, allowMissingColumns=True)
    docs = whole
    for _, function in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = function(spark, docs, SMALL)
        assert docs.columns == before.columns
    out = corpus_pipeline.encode(spark, docs, SMALL).toPandas()
    assert 0 < len(out) <= whole.count() and "ids" in out
    nothing = no_docs
    for _, function in corpus_pipeline.STAGES:
        nothing = function(spark, nothing, SMALL)
    assert nothing.count() == 0
