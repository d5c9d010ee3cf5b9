from __future__ import annotations

import random

import pytest

from postcluster.llm.components import components


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up) if root(x) != x}


@pytest.mark.parametrize("edges", [
    [],
    [(1, 1), (None, 2), (3, 3)],
    [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 200)] + [(500, i) for i in range(150, 160)],
    [(5, 2), (2, 5), (2, 9), (9, 7), (11, 12)],
    random.Random(3).sample([(i, j) for i in range(80) for j in range(80)], 70),
])
def test_equals_union_find(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    got = {r.id: r.component for r in components(df).collect()}
    assert got == brute(edges)
