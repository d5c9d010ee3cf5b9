from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from postcluster.llm import minhash_dedup as md
from postcluster.llm.catalog import op4_minhash_dedup, oracle_queries
from tests.llm.conftest import SF, clashing_words
from tests.llm.sql import same_rows


def set_of(text, k=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, percent=85):
    """(n, component) of (id, text) by all pairs."""
    sets = [set_of(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                a, b = sorted((a, b), key=lambda x: rows[x][0])
                up[b] = a
    return {rows[i][0]: (len(sets[i]), rows[root(i)][0]) for i in range(len(rows))}


def check(got, want):
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.id == r.component_id) for r in got)


def corpus(seed=1, families=25, size=8):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    line = [rng.choice(vocabulary) for _ in range(15)]
    texts = [None, "", "  ", "one", "ONE", "one two", "one two three", "One\ttwo three", "a " * 3000]
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 150))] + line * (f % 2)
        for _ in range(size):
            new = list(base)
            for _ in range(rng.randrange(0, 6)):
                new[rng.randrange(len(new))] = rng.choice(vocabulary)
            texts.append(" ".join(new))
    return texts


SMALL = {"CHUNK": 5, "TILE_SETS": 6, "PROBES": 3}


@pytest.mark.parametrize("leaf,sizes", [(64, {}), (3, {**SMALL, "TILE_SHINGLES": 300, "COMPARED": 256})])
def test_equals_all_pairs(spark, docs, leaf, sizes, monkeypatch):
    for name, size in sizes.items():
        monkeypatch.setattr(md, name, size)
    texts = corpus()
    got = md.near_documents(docs(texts).repartition(4), leaf=leaf).collect()
    check(got, brute(list(enumerate(texts))))


def made_signatures(spark, tokens):
    """Sets of 100 shingles with equal root tokens: all share all roots."""
    rows = np.concatenate([np.full((len(tokens), 4 * md.TREES), 7, np.uint8), tokens], axis=1)
    return spark.createDataFrame([(i, 100, bytearray(s.tobytes())) for i, s in enumerate(rows)],
                                 "rep long, n long, sig binary")


def test_large_nodes_branch_until_pairs_are_found(spark, monkeypatch):
    monkeypatch.setattr(md, "CHUNK", 20)
    tokens = np.repeat(np.random.default_rng(5).integers(0, 256, (150, md.TOKENS), dtype=np.uint8), 2, axis=0)
    edges = md.candidates(made_signatures(spark, tokens), leaf=4)
    assert {(min(r), max(r)) for r in edges.collect()} == {(i, i + 1) for i in range(0, 300, 2)}


def test_alike_nodes_end_with_all_their_sets(spark, monkeypatch):
    monkeypatch.setattr(md, "CHUNK", 20)
    rng = np.random.default_rng(6)
    family = np.tile(rng.integers(0, 256, (1, md.TOKENS), dtype=np.uint8), (200, 1))
    family[-1, : md.TOKENS // 2] += 1  # half like the family: no pair
    stray = family[-1:].copy()         # but like this one
    edges = md.candidates(made_signatures(spark, np.concatenate([family, stray])), leaf=8).collect()
    group = {r.id: r.component for r in md.components(spark.createDataFrame(edges)).collect()}
    assert all(group[i] == 0 for i in range(1, 199)) and 199 not in group and group[200] == 199


def test_recall_by_similarity(spark, docs, monkeypatch):
    """Pairs planted among documents that share half of their words, so that
    nodes branch several times."""
    monkeypatch.setattr(md, "CHUNK", 20)
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(60)]
    texts, bands = [], {"0.85": [], "0.87": [], "0.90": []}
    for k in range(360):
        edits, size = ((3, 60), (3, 92), (1, 60))[k % 3]
        one = shared + [f"w{rng.randrange(10 ** 6)}" for _ in range(size)]
        two = list(one)
        for at in rng.sample(range(62, len(one) - 3, 4), edits):
            two[at] = f"x{rng.randrange(10 ** 6)}"
        texts += [" ".join(one), " ".join(two)]
        a, b = set_of(texts[-2]), set_of(texts[-1])
        s = len(a & b) / len(a | b)
        bands["0.90" if s >= 0.9 else "0.87" if s >= 0.87 else "0.85"].append(2 * k)
        assert s >= 0.85
    group = {r.id: r.component_id for r in md.near_documents(docs(texts), leaf=8).collect()}
    for band, firsts in bands.items():
        assert len(firsts) >= 100 and np.mean([group[i] == group[i + 1] == i for i in firsts]) >= 0.95, band


def test_one_passage_in_all_documents(spark, docs):
    rng = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [passage + " " + " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(20, 80))) for _ in range(3000)]
    texts += [t + " end" for t in texts[:40]]
    got = {r.id: r.component_id for r in md.near_documents(docs(texts).repartition(8)).collect()}
    sets = [set_of(t) for t in texts]
    assert [got[i] for i in range(3000, 3040)] == list(range(40)) and all(got[i] == i for i in range(40))
    apart = [i for i in range(3000) if got[i] != i]
    assert all(len(sets[i] & sets[got[i]]) >= 0.7 * len(sets[i] | sets[got[i]]) for i in apart)


def test_words_made_to_clash(spark, docs):
    one, two = clashing_words()
    got = md.near_documents(docs([one, two, f"a {one} b", f"a {two} b"])).collect()
    assert {r.id: r.component_id for r in got} == {i: i for i in range(4)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 3000).astype(np.uint64)
    for size in (1, 5, 40, 3000):
        sig = md.signatures([np.sort(base[:size]), np.sort(base[:size]), np.zeros(0, np.uint64)])
        assert (sig[0] == sig[1]).all()
    near = md.signatures([np.sort(base[:1000]), np.sort(base[100:1100])])[:, 4 * md.TREES:]
    assert abs((near[0] == near[1]).mean() - 900 / 1100) < 0.12


def test_sets_equal_plain_sets():
    texts = [None, "", "a", "a b", "a b a b a b", "X y Z x Y z é É"]
    assert [len(s) for s in md.shingle_sets(pa.array(texts), 3)] == [len(set_of(t)) for t in texts]


def test_repeated_rows_null_ids_clashing_columns_and_empty_table(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (None, "a b c d", "z"), (2, "A b C d", "w"), (3, None, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    got = sorted((str(r.id), r.n_shingles, str(r.component_id), r.kept) for r in md.near_documents(df).collect())
    assert got == [("1", 2, "1", True), ("1", 2, "1", True), ("2", 2, "1", False), ("3", 0, "3", True),
                   ("None", 2, "None", True)]
    assert md.near_documents(df.limit(0)).collect() == []


def test_query_over_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op4_minhash_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)


def test_query_equals_its_sql(spark):
    same_rows(op4_minhash_dedup(spark, SF), oracle_queries()["op4_minhash_dedup"], SF)
