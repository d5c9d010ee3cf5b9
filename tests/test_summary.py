"""Cluster summary, language counts and the text report."""

from __future__ import annotations

from postcluster.operators.summary import cluster_language_counts, cluster_summary, report_lines
from postcluster.params import REPORT_HEADER, ClusterParams

P = ClusterParams()


def test_negative_even_median_truncates_toward_zero(spark):
    v = spark.createDataFrame([(0, -3), (0, -2)], "x int, y int")
    row = cluster_summary(v, [(0, 0)], P).first()
    assert (row["median_score"], row["size"], row["lang"], row["lang_percent"]) == (-2, 2, "JavaScript", 100.0)


def test_odd_median_and_weights(spark):
    w = spark.createDataFrame([(50000, 1, 3), (50000, 10, 1), (50000, 7, 1)], "x int, y int, n bigint")
    assert cluster_summary(w, [(50000, 0)], P).first()["median_score"] == 1


def test_tied_languages_pick_lower_index(spark):
    v = spark.createDataFrame([(100000, 1), (50000, 1), (100000, 3), (50000, 3)], "x int, y int")
    row = cluster_summary(v, [(75000, 0)], P).first()
    assert (row["lang"], row["lang_percent"], row["size"], row["median_score"]) == ("Java", 50.0, 4, 2)
    truncated = cluster_summary(v, [(75000, 0)], P, exact_percent=False).first()
    assert truncated["lang_percent"] == 0.0


def test_ordered_by_median_and_empty_clusters_absent(spark):
    v = spark.createDataFrame([(0, 50), (0, 52), (0, 1), (0, 3)], "x int, y int")
    rows = cluster_summary(v, [(0, 51), (0, 2), (900000, 0)], P).collect()
    assert [(r["cluster"], r["median_score"]) for r in rows] == [(1, 2), (0, 51)]


def test_language_counts(spark):
    v = spark.createDataFrame([(0, 1), (50000, 1), (50000, 2)], "x int, y int")
    got = sorted(tuple(r) for r in cluster_language_counts(v, [(25000, 0)], P).collect())
    assert got == [(0, "Java", 2), (0, "JavaScript", 1)]


def test_report_lines(spark):
    v = spark.createDataFrame([(350000, 5), (350000, 7), (50000, 1)], "x int, y int")
    lines = [r["line"] for r in report_lines(cluster_summary(v, [(50000, 0), (350000, 0)], P)).orderBy("line_no").collect()]
    assert lines[:3] == list(REPORT_HEADER)
    assert lines[3] == "      1  Java              (100.0%)            1"
    assert lines[4] == "      6  CSS               (100.0%)            2"


def test_write_report_round_trip(spark, tmp_path):
    from postcluster.operators.summary import write_report

    v = spark.createDataFrame([(350000, 5), (350000, 7), (50000, 1)], "x int, y int")
    lines = report_lines(cluster_summary(v, [(50000, 0), (350000, 0)], P))
    out = tmp_path / "report"
    write_report(lines, str(out))
    files = sorted(out.glob("part-*"))
    assert len(files) == 1
    assert files[0].read_text().splitlines() == list(REPORT_HEADER) + [
        "      1  Java              (100.0%)            1",
        "      6  CSS               (100.0%)            2",
    ]
