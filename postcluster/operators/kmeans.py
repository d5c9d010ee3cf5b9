"""k-means over integer 2-D points (Lloyd iterations).

Plan per iteration: the k centers are literals in a projection
(``with_nearest_center``), followed by a ``sum`` per cluster.  Only the k
aggregate rows come back to the driver, which fills empty clusters with
their old center, sums the shift and decides whether to go on.

The points are first merged into weighted points (one row per distinct
``(x, y)``, bounded by languages times distinct scores) and written once to
the shared checkpoint folder, so a lost executor re-reads that file rather
than re-running the upstream join.  A pass sums each task's points per cluster
before its shuffle, which so carries at most k rows a task.

Semantics (the contract of the original job, with its defects fixed):

* the nearest center is the lowest squared distance, lowest index on ties;
* a new center is the mean of its points, each component truncated toward
  zero (sums are exact 64-bit integers);
* a cluster without points keeps its old center;
* the shift is the sum over clusters of the squared distance old -> new,
  and the run stops when it is below ``eta`` (strict) or after
  ``max_iterations`` passes; the centers of the last pass are returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postcluster.functions.geometry import Point, squared_distance_py, with_nearest_center
from postcluster.operators.vectors import ensure_weighted
from postcluster.params import DEFAULT_PARAMS, ClusterParams
from postcluster.session import materialize

TRACE_SCHEMA = (
    "iteration int, cluster int, old_x int, old_y int, x int, y int, "
    "moved double, total_shift double, converged boolean"
)
CENTER_SCHEMA = "cluster int, x int, y int"


def assign_clusters(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    """Adds ``cluster`` (nearest center index) and ``distance`` (squared).

    One pass over possibly many rows: the codegen-friendly column form.
    """
    return with_nearest_center(points, centers, method="columns")


def cluster_sums(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    """``cluster, x, y, n`` for every non-empty cluster: the new centers.

    ``x``/``y`` are ``sum div count`` (truncated toward zero).  Works on
    vectors or weighted points.
    """
    # Few rows, one plan per iteration: the array form reuses compiled code.
    weighted = with_nearest_center(ensure_weighted(points), centers, method="array")
    assigned = weighted.select(
        "cluster",
        (F.col("x").cast("bigint") * F.col("n")).alias("wx"),
        (F.col("y").cast("bigint") * F.col("n")).alias("wy"),
        F.col("n"),
    )
    sums = assigned.groupBy("cluster").agg(
        F.sum("wx").alias("sx"), F.sum("wy").alias("sy"), F.sum("n").alias("n")
    )
    return sums.select(
        "cluster",
        F.expr("cast(sx div n as int)").alias("x"),
        F.expr("cast(sy div n as int)").alias("y"),
        "n",
    )


def centers_frame(spark: SparkSession, centers: Sequence[Point]) -> DataFrame:
    """The k centers as a DataFrame ``cluster, x, y`` (k is a parameter, not data)."""
    return spark.createDataFrame(
        [(i, int(x), int(y)) for i, (x, y) in enumerate(centers)], CENTER_SCHEMA
    )


def center_update(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    """One Lloyd step as a DataFrame: ``cluster, old_x, old_y, x, y, n``.

    Covers all k clusters; an empty one keeps its old center with n = 0.
    """
    old = centers_frame(points.sparkSession, centers).select(
        "cluster", F.col("x").alias("old_x"), F.col("y").alias("old_y")
    )
    new = cluster_sums(points, centers)
    return old.join(new, "cluster", "left").select(
        "cluster",
        "old_x",
        "old_y",
        F.coalesce(F.col("x"), F.col("old_x")).alias("x"),
        F.coalesce(F.col("y"), F.col("old_y")).alias("y"),
        F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n"),
    )


def center_shift(points: DataFrame, centers: Sequence[Point], eta: float = DEFAULT_PARAMS.eta) -> DataFrame:
    """Per cluster squared move of one Lloyd step, with the total and the verdict."""
    step = center_update(points, centers)
    moved = (
        (F.col("x").cast("double") - F.col("old_x").cast("double")) ** 2
        + (F.col("y").cast("double") - F.col("old_y").cast("double")) ** 2
    )
    # One window over the k cluster rows (k is a parameter, not data size).
    with_moved = step.withColumn("moved", moved).withColumn(
        "total_shift", F.sum("moved").over(Window.partitionBy())
    )
    return with_moved.select(
        "cluster", "old_x", "old_y", "x", "y", "moved", "total_shift",
        (F.col("total_shift") < F.lit(float(eta))).alias("converged"),
    )


@dataclass
class KMeansResult:
    initial: list[Point]
    centers: list[Point]
    iterations: int
    converged: bool
    trace: list[tuple] = field(default_factory=list)

    def centers_frame(self, spark: SparkSession) -> DataFrame:
        return centers_frame(spark, self.centers)

    def trace_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.trace, TRACE_SCHEMA)

    def trace_lines(self) -> list[str]:
        """One line a pass (its number, the total shift, how many centers
        moved), then one for the outcome."""
        passes: dict[int, list[tuple]] = {}
        for row in self.trace:
            passes.setdefault(row[0], []).append(row)
        lines = [
            f"pass {i}: shift {rows[0][7]:.1f}, {sum(r[6] > 0 for r in rows)} of {len(rows)} centers moved"
            for i, rows in sorted(passes.items())
        ]
        end = "converged" if self.converged else "stopped at the pass limit"
        return [*lines, f"{end} after {self.iterations} passes"]

    def print_trace(self) -> None:
        """Print :meth:`trace_lines` (the trace is already on the driver)."""
        print("\n".join(self.trace_lines()))


def loop_input(weighted: DataFrame) -> DataFrame:
    """The weighted points as the k-means loop reads them: cached.  The cache
    sits on top of the written file, so a lost executor rebuilds it from
    there.  They stay spread over their tasks, however few they are."""
    return weighted.persist(StorageLevel.MEMORY_AND_DISK)


def lloyd_step(points: DataFrame, means: Sequence[Point]) -> list[Point]:
    """New centers from one pass; empty clusters keep their old center."""
    new = list(means)
    for row in cluster_sums(points, means).collect():  # at most k rows
        new[row["cluster"]] = (int(row["x"]), int(row["y"]))
    return new


def kmeans(points: DataFrame, initial: Sequence[Point],
           params: ClusterParams = DEFAULT_PARAMS, materialize_input: bool = True) -> KMeansResult:
    """Run Lloyd iterations from ``initial`` until the shift is below eta.

    ``points`` are vectors or weighted points.  Unless the caller has
    already written them (``materialize_input=False``), they are merged and
    written once to the checkpoint folder before the loop.
    """
    if len(initial) == 0:
        raise ValueError("k-means needs at least one initial center")
    written = materialize(ensure_weighted(points), "weighted-points") if materialize_input else None
    weighted = loop_input(written.frame if written else ensure_weighted(points))
    try:
        means = [(int(x), int(y)) for x, y in initial]
        trace: list[tuple] = []
        iteration = 0
        converged = False
        while True:
            iteration += 1
            new = lloyd_step(weighted, means)
            moved = [squared_distance_py(a, b) for a, b in zip(means, new)]
            total = 0.0
            for m in moved:
                total += m
            converged = total < params.eta
            for i, ((ox, oy), (nx, ny)) in enumerate(zip(means, new)):
                trace.append((iteration, i, ox, oy, nx, ny, moved[i], total, converged))
            means = new
            if converged or iteration >= params.max_iterations:
                break
        return KMeansResult(list(initial), means, iteration, converged, trace)
    finally:
        weighted.unpersist()
        if written is not None:
            written.discard()
