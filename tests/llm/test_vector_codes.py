from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from postcluster.llm import vector_codes as vc
from postcluster.llm.catalog import op12_vector_codes, oracle_queries
from tests.llm.conftest import SF
from tests.llm.sql import same_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=16, entries=64, rounds=2):
    """{row number: (code, error, label_error, digest)} by all entries, in Python integers."""
    kept = [(i, v, lab, k) for k, (i, v, lab) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = {k: [math.floor(256 * float(np.float32(x))) for x in v] for _, v, _, k in kept}
    first = sorted((i, whole[k]) for i, _, _, k in kept if i is not None)[:entries]
    dim = len(first[0][1])
    width = dim // parts
    cutp = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cutp(v, p) for _, v in first] for p in range(parts)]
    coded = [k for *_, k in kept if len(whole[k]) == dim]

    def nearest(p, x):
        d = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            mine = [[] for _ in books[p]]
            for k in coded:
                mine[nearest(p, cutp(whole[k], p))[0]].append(cutp(whole[k], p))
            books[p] = [[sum(c) // len(m) for c in zip(*m)] if m else e for m, e in zip(mine, books[p])]
    found = {k: [nearest(p, cutp(whole[k], p)) for p in range(parts)] for k in coded}
    error = {k: sum(d for _, d in f) for k, f in found.items()}
    by_label = {}
    for _, _, lab, k in kept:
        by_label[lab] = by_label.get(lab, 0) + error.get(k, 0)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{e:02x}" for e, _ in found[k]) if k in found else None, error.get(k),
                    by_label[lab], digest) for i, _, lab, k in kept), key=repr)


def found(df, **how):
    return sorted((tuple(r) for r in vc.compress(df, **how).collect()), key=repr)


def test_slices_find_the_nearest_entry_and_the_lowest_of_ties():
    rng = np.random.default_rng(1)
    for dims, spread, n in ((1, 3, 64), (4, 2, 64), (4, 300, 64), (3, 1 << 22, 17), (4, 1 << 23, 1)):
        entries = rng.integers(-spread, spread + 1, (n, dims))
        x = np.concatenate([rng.integers(-spread, spread + 1, (500, dims)), entries])
        index, distance = vc.Codebook(entries).nearest(x)
        all_ = np.square(x[:, None, :] - entries[None]).sum(axis=2)
        assert (distance == all_.min(axis=1)).all() and (index == all_.argmin(axis=1)).all()


def test_equals_all_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.normal(0, 0.3, 32).astype(np.float32).tolist(), int(rng.integers(0, 4)) or None)
            for i in rng.permutation(300)]
    rows += [(1000, None, 1), (1001, [None] * 32, 1), (1002, [float("nan")] * 32, 2), (1003, [float("inf")] + [0.0] * 31, 2),
             (None, rows[3][1], 3), (None, [0.0] * 32, None), (7, rows[3][1], 3), (7, rows[3][1], 3), (1004, [0.5] * 31, 1),
             (1005, [], 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    assert found(df) == want and len(want) == 306
    assert found(df.repartition(1)) == want
    assert [r for r in want if r[0] == 1004][0][1:3] == (None, None)


@pytest.mark.parametrize("n", [1, 5])
def test_few_vectors_and_lengths_that_parts_do_not_divide(spark, n):
    rows = [(i, [i / 7, -i / 3, 0.25], None) for i in range(n)]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert [r[2] for r in got] == [0] * n  # each is an entry of its own
    books = vc.learn_codebooks(spark.createDataFrame(rows, SCHEMA))
    assert vc.decode([r[1] for r in got], books).tolist() == [
        [math.floor(256 * float(np.float32(x))) for x in v] for _, v, _ in rows]
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_large_components_and_clashing_columns(spark):
    rows = [(1, [0.5] * 16, 1, "c", 9), (2, [1e30] * 16, 1, "d", 8)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label int, code string, error int")
    books = vc.learn_codebooks(df, vec_id="id")
    got = sorted((tuple(r._row)[3:], r.code, r.error) for r in vc.encode(df, books).collect())
    assert got == [(("c", 9), "00" * 16, 0), (("d", 8), None, None)]


def test_query_equals_its_sql(spark):
    same_rows(op12_vector_codes(spark, SF), oracle_queries()["op12_vector_codes"], SF)
