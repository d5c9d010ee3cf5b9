"""Spark results against plain-Python models of the job, on skewed and random inputs."""

from __future__ import annotations

import random
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postcluster.operators.kmeans import kmeans
from postcluster.operators.pairing import grouped_postings, scored_postings
from postcluster.operators.summary import cluster_summary
from postcluster.params import ClusterParams

# -- plain-Python models ------------------------------------------------------


def model_scored(postings):
    """Pair questions with answers, group pairs by whole question posting, max score."""
    questions = [p for p in postings if p[0] == 1]
    answers = [p for p in postings if p[0] == 2 and p[3] is not None]
    by_parent = defaultdict(list)
    for a in answers:
        by_parent[a[3]].append(a)
    best = {}
    for q in questions:
        for a in by_parent.get(q[1], []):
            best[q] = max(best.get(q, a[4]), a[4])
    return sorted((q + (s,) for q, s in best.items()), key=repr)


def model_grouped(postings):
    questions = [p for p in postings if p[0] == 1]
    answers = [p for p in postings if p[0] == 2 and p[3] is not None]
    q_count = defaultdict(int)
    for q in questions:
        q_count[q[1]] += 1
    a_by = defaultdict(list)
    for a in answers:
        a_by[a[3]].append(a)
    out = []
    for qid, n in q_count.items():
        if qid in a_by:
            ans = a_by[qid]
            out.append((qid, n, len(ans), n * len(ans), min(a[1] for a in ans),
                        max(a[1] for a in ans), max(a[4] for a in ans)))
    return sorted(out)


def _trunc_div(a: int, b: int) -> int:
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


def model_kmeans(points, means, eta, max_iterations):
    means = list(means)
    for iteration in range(1, max_iterations + 1):
        groups = defaultdict(list)
        for p in points:
            d = [(p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 for c in means]
            groups[d.index(min(d))].append(p)
        new = list(means)
        for i, ps in groups.items():
            new[i] = (_trunc_div(sum(p[0] for p in ps), len(ps)), _trunc_div(sum(p[1] for p in ps), len(ps)))
        shift = sum((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 for a, b in zip(means, new))
        means = new
        if shift < eta:
            return means, iteration
    return means, max_iterations


def model_median(values):
    s = sorted(values)
    n = len(s)
    if n % 2:
        return s[n // 2]
    return _trunc_div(s[n // 2 - 1] + s[n // 2], 2)


# -- skewed fixture --------------------------------------------------------------


def test_hot_question_and_copies(postings_df):
    rng = random.Random(7)
    rows = []
    hot = (1, 1, None, None, 10, "Java")
    rows += [hot] * 300                                                   # exact copies
    rows += [(1, 1, None, None, 10 + i, "Java") for i in range(1, 40)]   # same id, other postings
    rows += [(1, q, None, None, q % 7, "Scala") for q in range(2, 200)]
    rows += [(2, 1000 + i, None, 1, rng.randint(-50, 50), None) for i in range(700)]   # hot answers
    rows += [(2, 5000 + i, None, rng.randint(2, 260), rng.randint(-9, 9), None) for i in range(600)]
    rows += [(2, 9000 + i, None, None, 3, None) for i in range(50)]
    assert len([r for r in rows if r[3] == 1]) >= len(rows) // 3
    df = postings_df(rows).repartition(6)
    got = sorted((tuple(r) for r in scored_postings(df).collect()), key=repr)
    assert got == model_scored(rows)
    assert sorted(tuple(r) for r in grouped_postings(df).collect()) == model_grouped(rows)


# -- random inputs ---------------------------------------------------------------

posting = st.one_of(
    st.tuples(st.just(1), st.integers(1, 12), st.none(), st.none(), st.integers(-5, 5),
              st.sampled_from(["Java", "Scala", None])),
    st.tuples(st.just(2), st.integers(100, 130), st.none(),
              st.one_of(st.none(), st.integers(1, 14)), st.integers(-20, 20), st.none()),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(posting, min_size=1, max_size=60))
def test_scoring_matches_model(postings_df, rows):
    df = postings_df(rows)
    assert sorted((tuple(r) for r in scored_postings(df).collect()), key=repr) == model_scored(rows)
    assert sorted(tuple(r) for r in grouped_postings(df).collect()) == model_grouped(rows)


point = st.tuples(st.integers(-3, 3).map(lambda i: i * 7), st.integers(-40, 40))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(point, min_size=1, max_size=50), st.lists(point, min_size=1, max_size=5))
def test_kmeans_and_summary_match_model(spark, points, start):
    df = spark.createDataFrame(points, "x int, y int")
    params = ClusterParams(langs=("a", "b", "c", "d", "e", "f", "g"), spread=7, kernels=len(start),
                           eta=1.0, max_iterations=15)
    res = kmeans(df, start, params)
    want, iterations = model_kmeans(points, start, 1.0, 15)
    assert res.centers == want and res.iterations == iterations
    groups = defaultdict(list)
    for p in points:
        d = [(p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 for c in res.centers]
        groups[d.index(min(d))].append(p)
    got = {r["cluster"]: (r["size"], r["median_score"]) for r in cluster_summary(df, res.centers, params).collect()}
    assert got == {i: (len(ps), model_median([p[1] for p in ps])) for i, ps in groups.items()}
