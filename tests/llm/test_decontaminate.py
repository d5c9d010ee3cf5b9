from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from postcluster.llm import decontaminate as dc
from postcluster.llm.catalog import op2_decontaminate
from tests.llm.conftest import SF, clashing_words

BENCH = "item_id long, text string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))


def least(item, text):
    """Least edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (w != t)))
        row = new
    return min(row)


def brute(docs, items, similarity=0.8):
    out = set()
    for d, text in docs:
        w = words_of(text)
        for i, item in items:
            m = words_of(item)
            if m and w and (n := least(m, w)) <= int((1 - similarity) * len(m) + 1e-9) and n < len(m):
                out.add((d, i, n))
    return out


VOCABULARY = [f"w{i}" for i in range(500)]


def planted(rng, edits, count):
    """Items of 5 to 60 words, and texts that hold them with a share of edits."""
    items, texts = [], []
    for i in range(count):
        item = [rng.choice(VOCABULARY) for _ in range(rng.randrange(5, 61))]
        items.append((i, " ".join(item)))
        near = list(item)
        for _ in range(int(edits * len(item))):
            k, how = rng.randrange(len(near)), rng.randrange(3)
            near[k:k + (how != 0)] = [rng.choice(VOCABULARY)] * (how != 1)
        around = [rng.choice(VOCABULARY) for _ in range(rng.randrange(80))]
        at = rng.randrange(len(around) + 1)
        texts.append(" ".join(around[:at] + near + around[at:]).title())
    return items, texts


def found(spark, texts, items, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = dc.find_leaks(docs, spark.createDataFrame(items, BENCH), **how).collect()
    assert len(rows) == len(texts)
    return {(r._row.doc_id, k.item_id, k.distance) for r in rows for k in r.leaks}


@pytest.mark.parametrize("edits,recall", [(0.0, 1.0), (0.1, 0.98), (0.2, 0.95)])
def test_recall_and_precision_against_brute_force(spark, edits, recall):
    items, texts = planted(random.Random(7), edits, 60)
    want = brute(enumerate(texts), items)
    got = found(spark, texts, items)
    assert got <= want and len(got) >= recall * len(want) and len(want) > 50


def test_recall_of_each_item_size():
    """Items with the most edits that they may have, for each size by itself."""
    rng = random.Random(11)
    for size in (*range(1, 61), 90, 150, 300):
        items, texts = [], []
        for i in range(100 if size <= 60 else 20):
            item = [rng.choice(VOCABULARY) for _ in range(size)]
            near = list(item)
            for _ in range(int(0.2 * size + 1e-9)):
                k, how = rng.randrange(len(near)), rng.randrange(4)
                near[k:k + (how != 0)] = [f"x{rng.randrange(10 ** 6)}"] * (how != 1)
            items.append((i, " ".join(item)))
            texts.append(" ".join(["q"] * rng.randrange(9) + near + ["r"] * rng.randrange(9)))
        got = dc.Finder(items, 0.8).leaks(pa.array(texts))
        hit = [any(k["item_id"] == i for k in leaks) for i, leaks in enumerate(got)]
        assert sum(hit) >= 0.9 * len(hit), (size, sum(hit))


def test_words_made_to_clash(spark):
    one, two = clashing_words()
    assert found(spark, [two, one], [(1, one)]) == {(1, 1, 0)}


def test_blocks_give_the_same_rows(spark):
    items, texts = planted(random.Random(8), 0.1, 30)
    assert found(spark, texts, items, block_words=100) == found(spark, texts, items)


def test_distance_program():
    rng = random.Random(1)
    for _ in range(200):
        item = [rng.randrange(4) for _ in range(rng.randrange(1, 80))]
        text = [rng.randrange(4) for _ in range(rng.randrange(1, 100))]
        assert min(dc.myers(item, text)) <= least(item, text) or least(item, text) == len(item)
        assert min(*dc.myers(item, text), len(item)) == least(item, text)


def test_edge_rows(spark):
    items = [(1, None), (2, ""), (3, "only"), (4, "Two words"), (5, "a b c d e f g h i j"), (6, "a b c d e f g h i j")]
    texts = [None, "", "   ", "only", "x two WORDS y", "a b c d e f g h i j " * 500, "a b c X d e f g h i j", "a b c d"]
    assert found(spark, texts, items) == {(3, 3, 0), (4, 4, 0), (5, 5, 0), (5, 6, 0), (6, 5, 1), (6, 6, 1)}
    assert found(spark, texts, []) == set()
    clash = spark.createDataFrame([(1, "only", "x", "y")], "doc_id long, text string, leaks string, row string")
    row = dc.find_leaks(clash, spark.createDataFrame(items, BENCH)).collect()[0]
    assert row._row.leaks == "x" and row.leaks[0].item_id == 3
    assert dc.find_leaks(clash.limit(0), spark.createDataFrame(items, BENCH)).collect() == []
    twice = spark.createDataFrame([(1, "only", "x", "y")] * 2, "doc_id long, text string, leaks string, row string")
    assert [len(r.leaks) for r in dc.find_leaks(twice, spark.createDataFrame(items, BENCH)).collect()] == [1, 1]


def test_query_over_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id, r.distance) for r in op2_decontaminate(spark, SF).collect()}
    # Brute force where an item can be: documents that share three words in a row with it.
    def runs(w):
        return {tuple(w[i:i + 3]) for i in range(len(w) - 2)}
    want = set()
    for i, item in items:
        near = [(d, t) for d, t in docs if runs(words_of(item)) & runs(words_of(t))]
        want |= brute(near, [(i, item)])
    assert got <= want and len(got) >= 0.98 * len(want) and got
