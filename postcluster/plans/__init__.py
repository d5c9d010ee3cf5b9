"""Compositions of the operators: the whole job, the query catalog, the oracle SQL."""

from postcluster.plans.clustering import (
    ClusteringOutcome,
    PreparedPoints,
    cluster_lines,
    cluster_points,
    cluster_postings,
    prepare_points,
    run,
)

__all__ = [
    "ClusteringOutcome",
    "PreparedPoints",
    "cluster_lines",
    "cluster_points",
    "cluster_postings",
    "prepare_points",
    "run",
]
