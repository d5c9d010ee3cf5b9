from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from postcluster.llm import mixing
from postcluster.llm.catalog import oracle_queries, op13_mixing
from tests.llm.conftest import SF
from tests.llm.sql import same_rows

SCHEMA = "doc_id long, text string, source string"


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling in exact fractions: full sources leave, the rest share anew."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        rest = Fraction(total - sum(most * sizes[s] for s in full))
        rate = rest / sum(weight[s] for s in open_) if open_ else 0
        above = [s for s in open_ if rate * weight[s] > most * sizes[s]]
        if not above:
            return {s: Fraction(most * sizes[s]) if s in full else rate * weight[s] for s in order}
        full.update(above)


def brute(rows, quality=None):
    """(doc_id, size, source_size, target, taken) of rows with different ids."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += size_of(text)
    target, taken = brute_targets(sizes), {}
    for source, total in sizes.items():
        budget = math.floor(target[source] + Fraction(1, 2))
        epochs, left = divmod(budget, total) if total else (0, 0)
        keyed = []
        for i, (d, text, s) in enumerate(rows):
            if s == source:
                u = (int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
                w = (quality or {}).get(d, 1.0)
                keyed.append((w <= 0, u if w <= 0 else -math.log(u) / w, str(d), i))
        for *_, i in sorted(keyed):
            n = size_of(rows[i][1])
            taken[i] = epochs * n + min(n, left)
            left -= min(n, left)
    return sorted((d, size_of(text), sizes[s], float(target[s]), taken[i]) for i, (d, text, s) in enumerate(rows))


def found(done):
    return sorted((r._row.doc_id, r.size, r.source_size, r.target, r.taken) for r in done.collect())


def same(got, want):
    assert [(a, b, c, e) for a, b, c, _, e in got] == [(a, b, c, e) for a, b, c, _, e in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def corpus():
    sizes = {"hot": 900, "b": 40, "c": 25, "É": 30, None: 12, "": 8, "tiny": 1, "none": 3}
    rows, i = [], 0
    for source, n in sizes.items():
        for k in range(n):
            text = None if source == "none" else "w\t" * ((k * 7) % 41) + ("x " * 3000 if k == 5 else "")
            rows.append((i, text, source))
            i += 1
    return rows


@pytest.mark.parametrize("bins", [1, 16, 4096])
def test_equals_a_plain_mix(spark, bins):
    rows = corpus()
    quality = {i: (0.0, 0.25, 4.0)[i % 3] for i, _, _ in rows if i % 4}
    weights = spark.createDataFrame(list(quality.items()), "doc_id long, quality double")
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute(rows, quality)
    same(found(mixing.mix_sources(df, weights, bins=bins)), want)
    by_source = defaultdict(int)
    for _, size, total, target, taken in want:
        assert taken <= 3 * size
        by_source[total, target] += taken
    assert all(abs(taken - target) <= 0.5 for (_, target), taken in by_source.items())
    assert any(target > total for total, target in by_source) and any(target < total for total, target in by_source)


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "a b c d", "x" if i < 600 else "y") for i in range(1200)]
    weights = spark.createDataFrame([(i, 9.0 if i % 2 else 1.0) for i in range(1200)], "doc_id long, quality double")
    got = found(mixing.mix_sources(spark.createDataFrame(rows, SCHEMA), weights, weights=(3, 1)))
    good, poor = (sum(r[4] for r in got if r[0] >= 600 and r[0] % 2 == k) for k in (1, 0))
    assert good > 3 * poor > 0


def test_the_mix_itself(spark):
    rows = [(1, "a\tb  c", "x"), (2, "d e f g h", "x"), (3, "p q", "y"), (4, None, "y")]
    df = spark.createDataFrame(rows, SCHEMA)
    done = mixing.mix_sources(df, weights=(1, 4))
    texts = [(r._row.doc_id, r.epoch, r.mixed_text) for r in mixing.mixed_texts(done).collect()]
    taken = {r._row.doc_id: r.taken for r in done.collect()}
    words = defaultdict(int)
    for d, epoch, text in texts:
        words[d] += size_of(text)
    assert dict(words) == {d: n for d, n in taken.items() if n} and sum(taken.values()) == 10
    assert [t for d, _, t in texts if d == 3] == ["p q"] * 3


def test_edge_rows(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (1, "a b c", "x"), (None, "d e", "x"), (None, None, None), (7, "", None)]
    got = mixing.mix_sources(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 6 and sum(r.taken for r in got) in (10, 11) and all(r.taken <= 3 * r.size for r in got)
    some = [(1, "a b c", "x")] * 5 + [(2, "k " * 40, "y")]
    got = mixing.mix_sources(spark.createDataFrame(some, SCHEMA), weights=(1, 8)).collect()
    assert sorted(r.taken for r in got if r._row.doc_id == 1) == [1] * 5  # five copies share six words of budget
    clash = spark.createDataFrame([(1, "a b", "x", 5, "q")], SCHEMA + ", size int, target string")
    row = mixing.mix_sources(clash).collect()[0]
    assert (row._row.size, row._row.target, row.size, row.taken) == (5, "q", 2, 2)
    assert mixing.mix_sources(clash.limit(0)).collect() == []


def test_many_sources_are_numbered_over_tasks(spark):
    names = [None if i == 7 else f"s{i:05d}" for i in range(3000)]
    got = mixing.numbered_sources(spark.createDataFrame([(n,) for n in names], "source string").repartition(6)).collect()
    want = {s: i for i, s in enumerate(sorted((n for n in names if n), key=str.encode))} | {None: 2999}
    assert {r.source: r.number for r in got} == want


def test_query_equals_its_sql(spark):
    same_rows(op13_mixing(spark, SF), oracle_queries()["op13_mixing"], SF)
