"""Physical plan properties that matter at scale."""

from __future__ import annotations

import re

import pytest

from postcluster.operators.kmeans import assign_clusters
from postcluster.operators.sampling import global_sample, stratified_sample
from postcluster.plans import catalog
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan(df, mode="formatted") -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join_or_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_SMALL))
    for node in FORBIDDEN:
        assert node not in text, f"{name} plans {node}"


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_center_assignment_never_runs_in_a_filter(spark, name):
    """An inferred not-null filter on the cluster index would be pushed
    below the point merge and evaluate the assignment on every raw row."""
    text = plan(catalog.QUERIES[name](spark, SF_SMALL), "simple")
    for line in text.splitlines():
        if "Filter " in line or "DataFilters" in line:
            assert "transform(" not in line and "__dist" not in line, f"{name}: {line[:200]}"


def test_scored_prunes_columns_and_aggregates_before_shuffle(spark):
    text = plan(catalog.scored_query(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert "struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in schemas
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in schemas
    assert "partial_max(answer_score" in text


def test_vectors_filter_reaches_the_orders_scan(spark):
    text = plan(catalog.label_vectors_query(spark, SF_SMALL))
    first_filter = text.split("(2) Filter")[1].split("(3)")[0]
    assert "array_position" in first_filter


def test_per_language_sample_limits_before_shuffle(spark):
    text = plan(stratified_sample(catalog._vectors(spark, SF_SMALL), catalog.DEFAULT_PARAMS))
    tree = text.split("\n\n")[0]
    # final limit, sort, shuffle by x, then a partial limit below the shuffle
    nodes = [re.sub(r"[\s:+\-]*", "", ln, count=1).split(" ")[0] for ln in tree.splitlines()[1:]]
    at = nodes.index("WindowGroupLimit")
    assert nodes[at:at + 4] == ["WindowGroupLimit", "Sort", "Exchange", "WindowGroupLimit"]


def test_global_sample_is_top_k(spark):
    df = global_sample(catalog._vectors(spark, SF_SMALL, catalog.MIXED_PARAMS), catalog.MIXED_PARAMS)
    assert "TakeOrderedAndProject" in plan(df)


def test_assignment_stays_in_codegen(spark):
    vectors = catalog._vectors(spark, SF_SMALL)
    df = assign_clusters(vectors, [(i * 50000, i) for i in range(45)])
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString()
    final = executed.split("== Initial Plan ==")[0]
    lines = [ln for ln in final.splitlines() if "__dist" in ln]
    assert len(lines) >= 3 and all("*(" in ln for ln in lines)


def test_hot_question_id_is_split_by_aqe(spark):
    """A third of all questions share one id (distinct postings): the join
    partition for it is skewed, and AQE splits it across tasks."""
    from pyspark.sql import functions as F

    from postcluster.operators.pairing import scored_postings

    confs = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.shuffle.partitions": "32",
    }
    saved = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 600_000
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id").cast("int"))
        q = spark.range(n).select(
            F.lit(1).alias("posting_type"), key.alias("id"), F.lit(None).cast("int").alias("accepted_answer"),
            F.lit(None).cast("int").alias("parent_id"), F.col("id").cast("int").alias("score"),
            F.md5(F.col("id").cast("string")).alias("tags"))
        a = spark.range(n).select(
            F.lit(2).alias("posting_type"), (F.col("id") + 10_000_000).cast("int").alias("id"),
            F.lit(None).cast("int").alias("accepted_answer"), key.alias("parent_id"),
            (F.col("id") % 97).cast("int").alias("score"), F.lit(None).cast("string").alias("tags"))
        out = scored_postings(q.unionByName(a)).agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.length("tags")).alias("chars"))
        row = out.collect()[0]
        assert row["rows"] == n and row["chars"] == 32 * n
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_reduction_scans_posting_text_once(spark, lines_file):
    from postcluster.operators.pairing import posting_reduction
    from postcluster.sources.text import read_postings

    path = lines_file(["1,6,,,140,CSS", "2,7,,6,-67", "2,8,,6,3"])
    tree = plan(posting_reduction(read_postings(spark, path))).split("\n\n")[0]
    assert tree.count("Scan text") == 1
    assert tree.count("Generate") == 1  # fields split once, below every later filter


def test_salted_scoring_equals_plain_scoring(postings_df):
    """For sessions without AQE's skew join; the rows do not depend on the salts."""
    from postcluster.operators.pairing import scored_postings

    rows = [(1, 7, None, None, s, "Java") for s in range(40)] + [
        (1, 8, None, None, 1, "Scala"), (2, 100, None, 7, 5, None), (2, 101, None, 7, 9, None),
        (2, 102, None, 8, -3, None)]
    df = postings_df(rows)
    plain = sorted(tuple(r) for r in scored_postings(df).collect())
    assert len(plain) == 41 and {r[-1] for r in plain if r[1] == 7} == {9}
    for salts in (2, 8):
        salted = scored_postings(df, salts)
        assert "salt" in plan(salted, "simple")
        assert sorted(tuple(r) for r in salted.collect()) == plain


def test_scoring_exchanges(spark):
    """Each half is exchanged for its aggregate and again, reduced, for the
    join: only so can AQE split a hot question id (see the test of that)."""
    from postcluster.operators.pairing import scored_postings
    from postcluster.sources.tables import postings_from_tables

    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = plan(scored_postings(postings_from_tables(spark, SF_SMALL)), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert tree.count("Exchange hashpartitioning") == 4
    assert "answer_id" not in tree


def test_salted_pairs_equal_plain_pairs(postings_df):
    from postcluster.operators.pairing import question_answer_pairs

    rows = [(1, 7, None, None, 1, "Java"), (1, 7, None, None, 2, "Java"), (1, 8, None, None, 1, None)] + [
        (2, 100 + i, None, 7, i % 5, None) for i in range(30)] + [(2, 200, None, 8, 3, None)]
    df = postings_df(rows)
    plain = sorted(tuple(r) for r in question_answer_pairs(df).collect())
    assert len(plain) == 61
    for salts in (3, 8):
        assert sorted(tuple(r) for r in question_answer_pairs(df, salts).collect()) == plain
