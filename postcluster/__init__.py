"""postcluster: question/answer posting clustering on Spark DataFrames.

Parse posting lines, pair questions with answers, take each question's best
answer score, turn tagged questions into 2-D points, sample initial centers,
run k-means and summarise each cluster -- all as Spark SQL plans.

    from postcluster import run
    outcome = run(spark, "path/to/postings")
"""

from postcluster.operators import (
    cluster_summary,
    initial_centers,
    kmeans,
    label_vectors,
    report_lines,
    scored_postings,
    weighted_points,
)
from postcluster.params import DEFAULT_PARAMS, LANGUAGES, ClusterParams
from postcluster.plans import cluster_lines, cluster_postings, prepare_points, run
from postcluster.sources import parse_postings, read_postings

__all__ = [
    "DEFAULT_PARAMS",
    "LANGUAGES",
    "ClusterParams",
    "cluster_lines",
    "cluster_postings",
    "cluster_summary",
    "initial_centers",
    "kmeans",
    "label_vectors",
    "parse_postings",
    "prepare_points",
    "read_postings",
    "report_lines",
    "run",
    "scored_postings",
    "weighted_points",
]
