"""Samples used as initial centers."""

from __future__ import annotations

import pytest

from postcluster.operators.sampling import global_sample, initial_centers, stratified_sample
from postcluster.params import ClusterParams

SMALL = ClusterParams(langs=("A", "B", "C"), spread=50000, kernels=6)


def vectors(spark, per_lang=5, langs=3):
    rows = [(i * 100 + j, i * 50000, j - 2) for i in range(langs) for j in range(per_lang)]
    return spark.createDataFrame(rows, "id int, x int, y int")


def test_stratified_sample_shape(spark):
    s = stratified_sample(vectors(spark), SMALL).collect()
    assert len(s) == 6
    assert sorted(r["cluster"] for r in s) == list(range(6))
    by_x = {}
    for r in s:
        by_x.setdefault(r["x"], []).append(r["rank"])
    assert {x: sorted(v) for x, v in by_x.items()} == {0: [1, 2], 50000: [1, 2], 100000: [1, 2]}


def test_sample_ignores_partitioning(spark):
    v = vectors(spark, per_lang=50)
    a = [tuple(r) for r in stratified_sample(v, SMALL).orderBy("cluster").collect()]
    b = [tuple(r) for r in stratified_sample(v.repartition(7, "y"), SMALL).orderBy("cluster").collect()]
    assert a == b
    params = ClusterParams(langs=("A", "B", "C"), spread=1, kernels=6)
    c = [tuple(r) for r in global_sample(v, params).orderBy("cluster").collect()]
    d = [tuple(r) for r in global_sample(v.repartition(5), params).orderBy("cluster").collect()]
    assert c == d and len(c) == 6


def test_seed_changes_sample(spark):
    v = vectors(spark, per_lang=50)
    a = initial_centers(v, SMALL)
    b = initial_centers(v, ClusterParams(langs=("A", "B", "C"), spread=50000, kernels=6, seed=7))
    assert len(a) == len(b) == 6 and a != b


def test_too_few_rows_in_a_language(spark):
    rows = [(1, 0, 1), (2, 0, 2), (3, 50000, 1), (4, 100000, 1), (5, 100000, 3)]
    v = spark.createDataFrame(rows, "id int, x int, y int")
    with pytest.raises(ValueError, match="fewer than 2"):
        initial_centers(v, SMALL)


def test_missing_language_fails_total(spark):
    rows = [(1, 0, 1), (2, 0, 2), (3, 50000, 1), (4, 50000, 3)]
    v = spark.createDataFrame(rows, "id int, x int, y int")
    with pytest.raises(ValueError, match="expected 6"):
        initial_centers(v, SMALL)


def test_kernels_not_multiple_of_languages(spark):
    with pytest.raises(ValueError, match="multiple"):
        initial_centers(vectors(spark), ClusterParams(langs=("A", "B", "C"), kernels=7))


def test_global_sample_too_few_rows(spark):
    v = spark.createDataFrame([(1, 0, 1), (2, 1, 2)], "id int, x int, y int")
    with pytest.raises(ValueError, match="expected 6"):
        initial_centers(v, ClusterParams(langs=("A", "B", "C"), spread=1, kernels=6))


def test_overall_sample_does_not_depend_on_row_order(spark):
    """Questions of one id in two languages have one draw and one best score."""
    from postcluster.operators.sampling import global_sample

    rows = [(7, 0, 5), (7, 3, 5), (7, 9, 5), (8, 3, 1)]
    params = ClusterParams(spread=3, kernels=2, langs=("A", "B"))
    assert not params.samples_by_language
    got = set()
    for order in (rows, rows[::-1], [rows[1], rows[3], rows[0], rows[2]]):
        df = spark.createDataFrame(order, "id int, x int, y int").coalesce(1)
        got.add(tuple(sorted(tuple(r) for r in global_sample(df, params).collect())))
    assert len(got) == 1
