from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from postcluster.llm import substring_dedup as sd
from postcluster.llm.catalog import op7_substring_dedup, oracle_queries
from tests.llm.conftest import SF, clashing_words
from tests.llm.sql import same_rows


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(texts, width):
    docs = [words_of(t) for t in texts]
    seen = Counter(tuple(d[i:i + width]) for d in docs for i in range(len(d) - width + 1))
    out = []
    for d in docs:
        gone = set()
        for i in range(len(d) - width + 1):
            if seen[tuple(d[i:i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(d), len(gone), " ".join(w for i, w in enumerate(d) if i not in gone)))
    return out


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "日本"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passage, line = some(60), some(12)
    texts = [None, "", " \t\n", " ".join(some(9)), " ".join(some(3000)), "x " * 300, "a b c " * 40]
    for i in range(60):
        body = some(rng.randrange(5, 120))
        at = rng.randrange(len(body))
        extra = passage if i % 3 == 0 else line if i % 3 == 1 else passage[: rng.randrange(60)]
        texts.append(rng.choice([" ", "\n", "  "]).join(body[:at] + extra + body[at:]))
    return texts + texts[8:12] + [texts[8].upper()]


@pytest.mark.parametrize("width", [10, 35])
@pytest.mark.parametrize("hot", [2, 8, 10 ** 9])
def test_equals_counting_all_windows(spark, docs, width, hot, monkeypatch):
    monkeypatch.setattr(sd, "HOT_COUNT", hot)  # hot paths may not change the rows
    monkeypatch.setattr(sd, "SUB_BYTES", 100)
    texts = corpus()
    got = sd.remove_repeats(docs(texts).repartition(5), width).orderBy("_row.doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == brute(texts, width)


def test_streaming_keeps_buckets_whole(spark, docs, monkeypatch):
    texts = corpus()
    monkeypatch.setattr(sd, "SORT_BYTES", 100)
    got = sd.remove_repeats(docs(texts), 10).orderBy("_row.doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in got] == brute(texts, 10)


def test_array_helpers():
    x = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    for width in (1, 2, 3, 7, 28):
        assert sd.sliding_min(x, width).tolist() == [min(x[i:i + width]) for i in range(len(x) - width + 1)]
    for width in (1, 2, 3, 5, 35):
        h = sd.run_hashes(np.tile(np.arange(20, dtype=np.uint64), 3), width)
        assert len(h) == 61 - width and h[0] == h[20] and len(set(h[:20].tolist())) == 20


def test_windows_with_equal_low_bits_are_told_apart(spark, docs, monkeypatch):
    real = sd.run_hashes  # hashes that differ in their upper 16 bits alone
    monkeypatch.setattr(sd, "run_hashes", lambda v, width: (
        real(v, width) << np.uint64(48)) | np.uint64(0x123456789ABC) if width == 10 else real(v, width))
    windows = sd.Windows(sd.pa.array(["a b c d e f g h i j k l"]), 10)
    assert len(set((windows.hash & np.uint64((1 << 48) - 1)).tolist())) == 1 and len(set(windows.hash.tolist())) == 3
    packed = next(sd.super_kmers(iter([sd.pa.RecordBatch.from_arrays(
        [sd.pa.array([7]), sd.pa.array(["a b c d e f g h i j k l"])], names=["_row", "_text"])]), 10, sd.Hot([], [])))
    assert sd._repeated(sd.pa.Table.from_batches([packed]).sort_by("bucket"), 10).num_rows == 0


def test_words_made_to_clash(spark, docs):
    one, two = clashing_words()
    rest = " ".join(f"t{i}" for i in range(40))
    got = sd.remove_repeats(docs([f"{one} {rest}", f"{two} {rest}"]), 41).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(1, text, "a"), (1, text, "b"), (None, "z " + text, "c"), (2, "q", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, low string")
    got = sd.remove_repeats(df).collect()
    assert sorted((r._row.low, r.n_removed, r.kept) for r in got) == [
        ("a", 40, ""), ("b", 40, ""), ("c", 40, "z"), ("d", 0, "q")]
    assert sd.remove_repeats(df.limit(0)).collect() == []


def test_query_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = op7_substring_dedup(spark, SF).orderBy("doc_id").collect()
    want = [(r.doc_id, n, gone, hashlib.sha256(kept.encode()).hexdigest())
            for r, (n, gone, kept) in zip(rows, brute([r.text for r in rows], 35))]
    assert [tuple(r) for r in got] == want


def test_query_equals_its_sql(spark):
    same_rows(op7_substring_dedup(spark, SF), oracle_queries()["op7_substring_dedup"], SF)
