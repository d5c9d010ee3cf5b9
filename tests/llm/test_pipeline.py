"""Each stage against a brute-force version on its own input."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from postcluster.llm import toxicity
from tests.llm import test_decontaminate, test_minhash_dedup, test_substring_dedup
from tests.llm.conftest import DOCS, SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The rows that go into each stage, and those that come out of the last."""
    docs, frames = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        frames.append((name, docs.collect()))
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    return frames + [("out", docs.collect())]


def into(chain, name):
    names = [n for n, _ in chain]
    at = names.index(name)
    return chain[at][1], chain[at + 1][1]


def near_components(rows):
    """Components at five words and 0.8 by all pairs."""
    sets = {r.doc_id: test_minhash_dedup.set_of(r.text, 5) for r in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            a, b = sets[i], sets[j]
            if j < i and a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return {i: root(i) for i in ids}


def test_columns(chain):
    for name, rows in chain[:-1]:
        assert list(rows[0].asDict()) == COLUMNS, name
    assert {"doc_id", "ids", "n_tokens"} <= set(chain[-1][1][0].asDict())


def test_toxicity_drops_exactly_what_it_predicts(spark, chain):
    before, after = into(chain, "toxicity")
    docs = spark.createDataFrame(before, DOCS)
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    import pyarrow as pa
    score = model.scores(pa.array([r.text for r in before], pa.string()))
    assert {r.doc_id for r in after} == {r.doc_id for r, s in zip(before, score) if s < 0.5}


def test_one_of_each_near_group_stays(chain):
    before, after = into(chain, "near_dedup")
    components = near_components(before)
    assert sorted(r.doc_id for r in after) == sorted(set(components.values()))
    assert {r for r in after} <= set(before)


def test_repeats_are_cut(chain):
    before, after = into(chain, "substring_dedup")
    before = sorted(before, key=lambda r: r.doc_id)
    want = test_substring_dedup.brute([r.text for r in before], cp.PASSAGE_WORDS)
    got = sorted(after, key=lambda r: r.doc_id)
    assert [r.doc_id for r in got] == [r.doc_id for r in before]
    for a, b, (_, removed, kept) in zip(before, got, want):
        assert b.text == (kept if removed else a.text)
        assert b.n_chars == (len(kept) if removed else a.n_chars)


def test_leaks_are_dropped(spark, chain):
    before, after = into(chain, "decontamination")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    exact = {r.doc_id for r in before for _, t in items
             if f" {' '.join(test_decontaminate.words_of(t))} " in f" {' '.join(test_decontaminate.words_of(r.text))} "}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert exact <= gone
    for r in before:
        if r.doc_id in gone:
            assert test_decontaminate.brute([(r.doc_id, r.text)], items)


def test_ids_equal_the_public_library(chain):
    before, after = into(chain, "bpe")
    public = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: public.encode(r.text or "", add_special_tokens=False).ids for r in before}
    assert {r.doc_id: list(r.ids) for r in after} == want


def test_run_and_odd_rows(spark, chain, tmp_path):
    got = cp.run(spark, SF)
    assert sorted((r.doc_id, tuple(r.ids)) for r in got.collect()) == sorted(
        (r.doc_id, tuple(r.ids)) for r in chain[-1][1])
    long = " ".join(f"q{i}" for i in range(60))
    rows = [(None, None, None, None, None), (None, "some text here", "en", "s", 14), (1, "", "en", "s", 0),
            (2, long, "en", "s", 10), (2, long, "en", "s", 10), (3, "x " * 20000, "en", "s", 40000)]
    docs = spark.createDataFrame(rows, DOCS)
    for _, stage in cp.STAGES:
        empty = stage(spark, docs.limit(0), SF) if "ids" not in docs.columns else None
        assert empty is None or empty.collect() == []
        path = str(tmp_path / stage.__name__)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
    left = sorted((str(r.doc_id), r.n_tokens > 0) for r in docs.collect())
    assert left == [("1", False), ("2", True), ("3", False), ("None", False), ("None", True)]
