"""Nearest center, center update and the k-means loop."""

from __future__ import annotations

import pytest

from postcluster.operators.kmeans import (
    assign_clusters,
    center_shift,
    center_update,
    cluster_sums,
    kmeans,
    lloyd_step,
)
from postcluster.params import ClusterParams


def points(spark, rows):
    return spark.createDataFrame(rows, "x int, y int")


def test_tie_goes_to_lower_cluster(spark):
    df = points(spark, [(0, 0)])
    got = assign_clusters(df, [(0, 2), (0, -2), (2, 0)]).first()
    assert (got["cluster"], got["distance"]) == (0, 4.0)
    got = assign_clusters(df, [(5, 5), (0, 1), (1, 0)]).first()
    assert got["cluster"] == 1


def test_empty_cluster_keeps_old_center(spark):
    df = points(spark, [(0, 0), (0, 2)])
    assert lloyd_step(df, [(0, 1), (100, 100)]) == [(0, 1), (100, 100)]
    rows = {r["cluster"]: tuple(r) for r in center_update(df, [(0, 1), (100, 100)]).collect()}
    assert rows[1] == (1, 100, 100, 100, 100, 0)
    assert rows[0] == (0, 0, 1, 0, 1, 2)


def test_mean_truncates_toward_zero(spark):
    df = points(spark, [(0, -3), (0, -2), (1, 3), (2, 4)])
    got = {r["cluster"]: (r["x"], r["y"]) for r in cluster_sums(df, [(0, -1), (10, 10)]).collect()}
    # cluster 0 gets all four: x = 3 div 4 = 0, y = 2 div 4 = 0
    assert got == {0: (0, 0)}
    got = {r["cluster"]: (r["x"], r["y"]) for r in cluster_sums(points(spark, [(0, -3), (0, -2)]), [(0, 0)]).collect()}
    assert got == {0: (0, -2)}


def test_weighted_equals_unweighted(spark):
    raw = points(spark, [(0, 1), (0, 1), (0, 5), (9, 9), (9, 9), (9, 9)])
    weighted = spark.createDataFrame([(0, 1, 2), (0, 5, 1), (9, 9, 3)], "x int, y int, n bigint")
    c = [(0, 0), (10, 10)]
    a = sorted(tuple(r) for r in cluster_sums(raw, c).collect())
    b = sorted(tuple(r) for r in cluster_sums(weighted, c).collect())
    assert a == b == [(0, 0, 2, 3), (1, 9, 9, 3)]


def test_kmeans_converges_with_trace(spark):
    # pass 1: 0 -> c0; 2, 100, 104 -> c1 = 206 div 3 = 68; shift 67^2
    # pass 2: 0, 2 -> c0 = 1; 100, 104 -> c1 = 102; shift 1 + 34^2
    # pass 3: nothing moves; shift 0 < eta
    df = points(spark, [(0, 0), (0, 2), (0, 100), (0, 104)])
    res = kmeans(df, [(0, 0), (0, 1)], ClusterParams(eta=1.0, kernels=2, langs=("A", "B")))
    assert res.centers == [(0, 1), (0, 102)]
    assert res.converged and res.iterations == 3
    assert len(res.trace) == 2 * res.iterations
    first = [r for r in res.trace if r[0] == 1]
    assert [(r[2], r[3], r[4], r[5]) for r in first] == [(0, 0, 0, 0), (0, 1, 0, 68)]
    assert [r[7] for r in res.trace] == [67.0 ** 2] * 2 + [1.0 + 34.0 ** 2] * 2 + [0.0] * 2
    assert [r[8] for r in res.trace] == [False] * 4 + [True] * 2


def test_kmeans_stops_at_max_iterations(spark):
    df = points(spark, [(0, 0), (0, 2), (0, 100), (0, 104)])
    params = ClusterParams(eta=0.5, max_iterations=1, kernels=2, langs=("A", "B"))
    res = kmeans(df, [(0, 0), (0, 1)], params)
    assert res.iterations == 1 and not res.converged
    assert res.centers == [(0, 0), (0, 68)]


def test_no_centers_is_an_error(spark):
    df = points(spark, [(0, 0)])
    with pytest.raises(ValueError):
        assign_clusters(df, [])
    with pytest.raises(ValueError):
        kmeans(df, [])


def test_center_shift_totals(spark):
    # both points go to c0 (mean (0, 2)); c1 is empty and stays
    df = points(spark, [(0, 0), (0, 4)])
    rows = sorted(tuple(r) for r in center_shift(df, [(0, 0), (0, 10)], eta=20.0).collect())
    assert rows == [(0, 0, 0, 0, 2, 4.0, 4.0, True), (1, 0, 10, 0, 10, 0.0, 4.0, True)]


def test_trace_lines(spark, capsys):
    df = points(spark, [(0, 0), (0, 2), (0, 100), (0, 104)])
    res = kmeans(df, [(0, 0), (0, 1)], ClusterParams(eta=1.0, kernels=2, langs=("A", "B")))
    res.print_trace()
    assert capsys.readouterr().out.splitlines() == res.trace_lines()
    assert res.trace_lines() == [
        "pass 1: shift 4489.0, 1 of 2 centers moved",
        f"pass 2: shift {res.trace[2][7]:.1f}, 2 of 2 centers moved",
        "pass 3: shift 0.0, 0 of 2 centers moved",
        "converged after 3 passes",
    ]


def test_passes_and_summary_stay_distributed(spark):
    """Points in several partitions: each task sums its own before the exchange."""
    from postcluster.operators.kmeans import loop_input
    from postcluster.operators.summary import cluster_summary

    rows = [(50000 * (i % 3), i % 40, 1 + i % 2) for i in range(600)]
    weighted = spark.createDataFrame(rows, "x int, y int, n bigint").repartition(6)
    params = ClusterParams(eta=1.0, kernels=3, langs=("A", "B", "C"))
    start = [(0, 0), (50000, 20), (100000, 39)]
    held = loop_input(weighted)
    try:
        assert held.rdd.getNumPartitions() == 6
        tree = cluster_sums(held, start)._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in tree and tree.index("Exchange") < tree.index("partial_sum")
        assert "Coalesce" not in tree
    finally:
        held.unpersist()
    spread = kmeans(weighted, start, params, materialize_input=False)
    single = kmeans(weighted.coalesce(1), start, params, materialize_input=False)
    assert spread.centers == single.centers and spread.trace == single.trace
    got, want = (sorted(map(tuple, cluster_summary(w, spread.centers, params).collect()))
                 for w in (weighted, weighted.coalesce(1)))
    assert got == want and len(got) == 3
