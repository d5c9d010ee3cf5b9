from __future__ import annotations

import numpy as np
import pytest

from postcluster.llm import embedding_dedup as ed
from postcluster.llm.catalog import op6_embedding_dedup, oracle_queries
from tests.llm.conftest import SF
from tests.llm.sql import same_rows

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    """{row number: (n_links, component)} by all pairs."""
    vec = [None if v is None or lab is None or i is None or not v or any(x is None for x in v)
           or not np.isfinite(v).all() or not np.any(v) else np.array(v, np.float32).astype(float)
           for i, v, lab in rows]
    links = [set() for _ in rows]
    for p in range(len(rows)):
        for q in range(p):
            a, b = vec[p], vec[q]
            if a is not None and b is not None and rows[p][2] == rows[q][2] and len(a) == len(b):
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[p].add(q)
                    links[q].add(p)
    out = []
    for p in range(len(rows)):
        seen, todo = {p}, [p]
        while todo:
            for q in links[todo.pop()] - seen:
                seen.add(q)
                todo.append(q)
        out.append((rows[p][0], len(links[p]), None if rows[p][0] is None else min(rows[q][0] for q in seen)))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in rows)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in rows), key=repr)


@pytest.mark.parametrize("tile", [7, 1024])
def test_equals_all_pairs(spark, tile):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(6, 16))
    rows = [(i, (centers[i % 6] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.2])).tolist(), int(i % 2))
            for i in range(150)]
    rows += [(200, None, 1), (201, [0.0] * 16, 1), (202, [float("nan")] * 16, 1), (203, [None] * 16, 1), (204, [], 1),
             (205, rows[0][1], None), (206, rows[0][1][:8], 0), (None, rows[0][1], 0), (207, rows[0][1], 0),
             (208, [float("inf")] + [1.0] * 15, 1), (150, rows[3][1], 1), (151, rows[3][1], 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(ed.near_vectors(df, tile=tile)) == brute(rows)


def test_error_bound_holds():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 64))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * 0.2])
    for threshold in (0.9, 0.95, 0.98):
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        i, j = np.nonzero(np.triu(unit @ unit.T >= threshold, 1))
        assert set(zip(i, j)) == set(zip(*ed.links(x, None, threshold)))


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1.0], 1, 5)], SCHEMA + ", component_id int")
    assert ed.near_vectors(df).collect() == [(1, 0, 1, True)]
    assert ed.near_vectors(df.limit(0)).collect() == []


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert found(op6_embedding_dedup(spark, SF)) == brute(rows)


def test_query_equals_its_sql(spark):
    same_rows(op6_embedding_dedup(spark, SF), oracle_queries()["op6_embedding_dedup"], SF)
