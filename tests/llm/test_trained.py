"""Toxicity and quality: held-out accuracy, and the parts against plain code."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from postcluster.llm import quality, toxicity
from postcluster.llm.catalog import op9_toxicity, op10_quality
from postcluster.llm.learning import fit_rows, held_out
from postcluster.llm.words import scan

CHECK = "/root/testdata/sf0.1"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms, stems = [b"moron", b"pathetic", b"disgusting", b"trash"], [b"low"]
    automaton = toxicity.build_automaton(terms, stems)
    rng = np.random.default_rng(0)
    words = [b"moron", b"m0ron", b"pathetik", b"patetic", b"disgustin", b"digsusting", b"lowest", b"lo", b"low", b"slow"]
    for term in terms * 40:
        w = bytearray(term)
        for _ in range(rng.integers(0, 4)):
            k, c = rng.integers(0, len(w) + 1), rng.choice(list(b"abcmnoprst"))
            w = w[:k] + bytes([c]) * int(rng.integers(0, 2)) + w[k + int(rng.integers(0, 2)):]
        words.append(bytes(w) or b"x")
    scanned = scan(pa.array([" ".join(w.decode() for w in words)]), toxicity.TERM_WORDS, lower=True)
    for word, kind in zip(words, automaton.run(scanned)):
        best = [edits(word, t) for t in terms if edits(word, t) <= toxicity.edit_budget(t)]
        want = toxicity.STEM if word.startswith(b"low") else 0 if not best else (
            toxicity.EXACT if min(best) == 0 else toxicity.FUZZY)
        assert kind == want, word


def test_a_lexicon_beyond_one_automaton_keeps_all_terms(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "MAX_STATES", 250)
    rng = np.random.default_rng(4)
    terms = [bytes(rng.choice(list(b"abcdefghijklmnop"), 8).tolist()) for _ in range(12)]
    monkeypatch.setattr(toxicity, "learn_lexicon", lambda rows: (terms, [b"xylo", b"zzzz"]))
    none = spark.createDataFrame([], "doc_id long, text string, toxic int")
    automaton = toxicity.fit(none.drop("toxic"), none.drop("text")).automaton
    words = [*terms, *(t[:3] + t[4:] for t in terms), b"xylophon", b"zzzz", b"other"]
    scanned = scan(pa.array([" ".join(w.decode() for w in words)]), toxicity.TERM_WORDS, lower=True)
    want = [toxicity.EXACT] * 12 + [toxicity.FUZZY] * 12 + [toxicity.STEM] * 2 + [0]
    assert automaton.run(scanned).tolist() == want


QUOTED = ['he wrote "moron" there', 'he wrote \u201cmoron\u201d there', "\u00abmoron\u00bb", "\u00ab moron \u00bb", "\u00ab\u00a0moron\u00a0\u00bb",
          "\u201emoron\u201c sagte er", "\u00bbmoron\u00ab", "\u300cmoron\u300d", 'he wrote "you are a moron" there', "'moron' he said",
          '"You are a moron!" she shouted.', "she said \u2018it\u2019s a moron\u2019 again", '("moron")', '"what \'a fine\' moron"']
PLAIN = ["you moron there", "moron\u2026 yes", "moron\u2014yes", "\u00a1moron!", "\u00bfmoron?", "don't be a moron, it's true", "a moron's word",
         '"yes" moron "no"', 'he said "no', "moron", "rock \u2019n\u2019 roll, moron", '"' + "word " * 50 + "moron " + "word " * 50 + '"',
         "the \u201cyes\u201d of a moron"]


def test_open_quotations_weigh_less():
    automaton = toxicity.build_automaton([b"moron"], [])
    for texts, weight in ((QUOTED, toxicity.QUOTED_WEIGHT), ([t for t in PLAIN if "moron" in t], 1.0)):
        # One by one and all in one batch: marks of other texts play no part.
        for one in ([toxicity.features(pa.array([t]), automaton)[0] for t in texts], toxicity.features(pa.array(texts), automaton)):
            for text, row in zip(texts, one):
                assert np.isclose(np.expm1(row[0]), weight), text
    assert not toxicity.features(pa.array([None, "", "fine", '"'], pa.string()), automaton).any()


def test_features_and_score_equal_a_plain_version():
    automaton = toxicity.build_automaton([b"moron", b"idiotic"], [b"scum"])
    rng = np.random.default_rng(8)
    vocabulary = ["moron", "idiotik", "scumbag", "word", "other", "Moron", "h\u00e9"]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 60))) for _ in range(60)]
    weights = rng.normal(size=toxicity.FEATURES + 1)
    got, scores = toxicity.features(pa.array(texts), automaton), toxicity.Model(automaton, weights).scores(pa.array(texts))
    kinds = {"moron": 0, "Moron": 0, "idiotik": 1, "scumbag": 2}
    for text, row, score in zip(texts, got, scores):
        words = text.split()
        hits = [i for i, w in enumerate(words) if w in kinds]
        near = [np.log1p(sum(0 < abs(i - j) <= toxicity.WINDOW for j in hits) + 1) for i in hits]
        want = [sum(kinds[words[i]] == k for i in hits) for k in range(3)]
        want += [sum(near), 100 * len(hits) / max(len(words), 1), max(near, default=0)]
        assert np.allclose(row, np.log1p(want)), text
        x = float(np.dot(row, weights[:-1]) + weights[-1])
        assert np.isclose(score, 1 / (1 + np.exp(-x)))


def test_all_terms_with_evidence_are_taken(spark):
    terms = ["q" * 45] + [f"{c}{d}zzzz{c}" for c in "bcdfghjklmnpqrstvw" for d in "abcdefghijklmnopqrstuvwxyz0123456789"]
    rng = np.random.default_rng(3)
    rows = [(" ".join([*terms, *(f"own{i}words{k}" for k in range(40))]), 1) for i in range(12)]
    rows += [("window " + "".join(rng.choice(list("aeiou"), 12)), 0) for _ in range(300)]
    words, stems = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    covered = [t for t in terms if t.encode() in words or any(t.encode().startswith(s) for s in stems)]
    assert len(covered) == len(terms) > 512


def accuracy(got, labels, column):
    known = {r.doc_id: r[column] for r in labels.collect()}
    held = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    assert len(held) > 100
    return np.mean([p == y for p, y in held])


def test_toxicity_on_held_out_rows(spark):
    got = op9_toxicity(spark, CHECK).collect()
    labels = spark.read.parquet(f"{CHECK}/labels.parquet")
    assert len(got) == spark.read.parquet(f"{CHECK}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert accuracy(got, labels, "toxic") >= 0.97


def test_terms_of_a_small_language_are_learned(spark):
    rng = np.random.default_rng(2)

    def text(*terms):
        return " ".join([*("".join(rng.choice(list("abcdefghij"), 9)) for _ in range(8)), *terms])

    rows = [(text("moron"), 1) for _ in range(400)] + [(text("zoquete"), 1) for _ in range(8)]
    rows += [(text("window"), 0) for _ in range(1600)]
    words, _ = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, y int"))
    assert words == [b"moron", b"zoquete"]


def test_toxicity_recall_in_each_language(spark):
    """On rows that the fit has not seen."""
    docs, labels = (spark.read.parquet(f"{CHECK}/{t}.parquet") for t in ("documents", "labels"))
    toxic = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id").where(held_out(toxicity.F.col("doc_id")))
    got = toxicity.score_toxicity(toxic, toxicity.fit(docs, labels), keep=["lang"]).collect()
    for lang in ("de", "en", "es", "fr"):
        mine = [r.predicted for r in got if r._row.lang == lang]
        assert len(mine) >= 5 and np.mean(mine) >= 0.85, lang


def test_the_fit_is_bounded_whatever_repeats(spark):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(50)] + [(2, "x"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in (1, 1, 2, 3)], "doc_id long, quality int, toxic int")
    got = fit_rows(docs, labels, "quality", 3).collect()
    assert len(got) <= 3 and [r.text for r in got if r.text and r.text.startswith("t")] in ([], ["t0"])


def test_quality_on_held_out_rows(spark):
    got = op10_quality(spark, CHECK).collect()
    labels = spark.read.parquet(f"{CHECK}/labels.parquet")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert accuracy(got, labels, "quality") >= 0.97


def test_edge_rows_and_no_labels(spark, docs):
    texts = [None, "", " ", "x" * 50000, "a b", "a b"]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (3, None, 7), (4, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, odd):
        for module, score in ((toxicity, toxicity.score_toxicity), (quality, quality.score_quality)):
            got = score(docs(texts), module.fit(docs(texts), labels)).collect()
            assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
            assert score(docs([]), module.fit(docs([]), labels)).collect() == []
    clash = spark.createDataFrame([(1, "a", 9.0)], "doc_id long, text string, score double")
    assert toxicity.score_toxicity(clash, toxicity.fit(clash, none)).collect()[0]._row.score == 9.0


def test_word_vectors_equal_plain_sums(spark, docs):
    texts = ["a b c a", None, "b a !! a", ""]
    at, sign = quality._signatures()
    want = np.zeros((quality.BUCKETS, quality.DIM))
    for text in texts:
        if not text:
            continue
        word = quality.buckets(pa.array([text]))[0]
        for i, w in enumerate(word):
            for j in range(max(0, i - quality.REACH), min(len(word), i + quality.REACH + 1)):
                if i != j:
                    for s in range(quality.SIGNS):
                        want[w, at[word[j], s]] += sign[word[j], s]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    got = quality.word_vectors(docs(texts).repartition(3))
    assert np.allclose(got, want / np.where(norm > 0, norm, 1), atol=1e-6)
