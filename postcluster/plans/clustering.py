"""The whole job, composed from the operators.

``cluster_postings`` is the original job's main flow: postings -> best
answer score per question -> 2-D vectors -> sample -> k-means -> per-cluster
summary.  Three tables are written once to the shared checkpoint folder:

* the per-question reduction of the postings (one row per distinct question
  and per answered id), partitioned by role: the input is scanned and
  parsed once, and each side of the question/answer join reads only its
  own part of this much smaller table;
* the vectors (``id, x, y``, 12 bytes a row): the sample and the point
  compression both read them, so the upstream scan and join run once;
* the weighted points (one row per distinct ``(x, y)``): every k-means
  iteration and the summary read them.

These writes cut the lineage, so a lost executor re-reads a file instead of
re-running the join.  Each is deleted once nothing reads it (the reduction
after the vectors are written, the vectors after the sample).  The summary
that comes back is a lazy DataFrame over the weighted points, which stay until
:meth:`ClusteringOutcome.discard` or :meth:`ClusteringOutcome.settle`.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postcluster.functions.geometry import Point
from postcluster.functions.language import first_language_index
from postcluster.operators.kmeans import KMeansResult, kmeans
from postcluster.operators.pairing import posting_reduction, scored_from_reduction
from postcluster.operators.sampling import initial_centers
from postcluster.operators.summary import cluster_summary, print_report, report_lines
from postcluster.operators.vectors import label_vectors, weighted_points
from postcluster.params import DEFAULT_PARAMS, ClusterParams
from postcluster.session import Written, materialize, settle
from postcluster.sources.text import parse_postings, read_posting_lines


@dataclass
class PreparedPoints:
    vectors_table: Written   # id, x, y
    weighted_table: Written  # x, y, n

    @property
    def vectors(self) -> DataFrame:
        return self.vectors_table.frame

    @property
    def weighted(self) -> DataFrame:
        return self.weighted_table.frame

    def discard_vectors(self) -> None:
        self.vectors_table.discard()

    def discard(self) -> None:
        self.vectors_table.discard()
        self.weighted_table.discard()


@dataclass
class ClusteringOutcome:
    points: PreparedPoints
    kmeans: KMeansResult
    summary: DataFrame

    @property
    def centers(self) -> list[Point]:
        return self.kmeans.centers

    def discard(self) -> None:
        """Delete the written points once the summary will not be read again."""
        self.points.discard()

    def settle(self, result: DataFrame | None = None) -> DataFrame:
        """The summary, or another result of at most a few rows per cluster
        and language, on its own; the written points are deleted."""
        settled = settle(self.summary if result is None else result)
        self.discard()
        return settled


def prepare_points(postings: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> PreparedPoints:
    """Vectors and weighted points of the postings, each written once.

    The per-question reduction is deleted as soon as the vectors are
    written: nothing reads it afterwards.
    """
    # Questions without a listed language never become vectors: drop them
    # before the reduction's shuffle (the written table would stop Catalyst
    # from pushing the later language filter down this far).
    known = first_language_index(F.col("tags"), params.langs).isNotNull()
    clusterable = postings.where((F.col("posting_type") != F.lit(1)) | known)
    # Split by role on disk: each half of the join reads only its directory.
    reduction = posting_reduction(clusterable).select("question_id", "is_question", "q_tags", "high_score")
    reduced = materialize(reduction, "posting-reduction", partition_by=("is_question",))
    vectors = materialize(label_vectors(scored_from_reduction(reduced.frame), params), "vectors")
    reduced.discard()
    weighted = materialize(weighted_points(vectors.frame), "weighted-points")
    return PreparedPoints(vectors, weighted)


def cluster_points(points: PreparedPoints, params: ClusterParams = DEFAULT_PARAMS,
                   exact_percent: bool = True, keep_vectors: bool = False) -> ClusteringOutcome:
    """Sample, run k-means and summarise prepared points.

    The vectors are only needed for the sample; unless ``keep_vectors``,
    their files are deleted once it is drawn.  The summary reads the
    weighted points, which stay until :meth:`ClusteringOutcome.discard`.
    """
    start = initial_centers(points.vectors, params)
    if not keep_vectors:
        points.discard_vectors()
    result = kmeans(points.weighted, start, params, materialize_input=False)
    summary = cluster_summary(points.weighted, result.centers, params, exact_percent)
    return ClusteringOutcome(points, result, summary)


def cluster_postings(postings: DataFrame, params: ClusterParams = DEFAULT_PARAMS,
                     exact_percent: bool = True) -> ClusteringOutcome:
    """Postings to cluster summary (the original job's main flow)."""
    return cluster_points(prepare_points(postings, params), params, exact_percent)


def cluster_lines(lines: DataFrame, params: ClusterParams = DEFAULT_PARAMS,
                  exact_percent: bool = True) -> ClusteringOutcome:
    """Posting text lines (``value``) to cluster summary."""
    return cluster_postings(parse_postings(lines), params, exact_percent)


def run(spark: SparkSession, path: str, params: ClusterParams = DEFAULT_PARAMS,
        debug: bool = False) -> ClusteringOutcome:
    """Read posting files at ``path``, cluster them and print the report
    (with ``debug``, print every k-means pass first).  Leaves no files."""
    outcome = cluster_lines(read_posting_lines(spark, path), params)
    if debug:
        outcome.kmeans.print_trace()
    summary = outcome.settle()
    print_report(report_lines(summary))
    return replace(outcome, summary=summary)
