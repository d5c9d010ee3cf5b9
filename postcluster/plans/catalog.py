"""Registered queries: one per operator of the job, each over the whole tables.

Every query takes ``(spark, sf_dir)``, derives postings from the test
tables (``sources.tables``) and returns a DataFrame.  Column names equal
those of the DuckDB oracle in ``plans.oracle``.

Queries that need centers run the sample (and k-means) eagerly: those steps
return k rows to the driver by design.  Results of a few rows per cluster are
settled, and what they were computed from is deleted; other results stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postcluster.operators.kmeans import assign_clusters, center_shift, center_update, centers_frame
from postcluster.operators.pairing import (
    grouped_posting_count,
    grouped_postings,
    lookup_rankings,
    question_answer_pairs,
    scored_postings,
)
from postcluster.operators.postings import answers, questions
from postcluster.operators.sampling import global_sample, initial_centers, stratified_sample
from postcluster.operators.summary import cluster_language_counts, cluster_summary, report_lines
from postcluster.operators.vectors import label_vectors, weighted_points, with_language_index
from postcluster.params import DEFAULT_PARAMS, MIXED_PARAMS, ClusterParams
from postcluster.plans.clustering import cluster_lines, cluster_points, prepare_points
from postcluster.session import materialize, settle
from postcluster.sources.tables import posting_text_from_tables, postings_from_tables
from postcluster.sources.text import parse_postings

Query = Callable[[SparkSession, str], DataFrame]


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_from_tables(spark, sf_dir)


def _vectors(spark: SparkSession, sf_dir: str, params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    return label_vectors(scored_postings(_postings(spark, sf_dir)), params)


def raw_posting_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines read and postings parsed (equal, or the parse fails), in one scan."""
    text = posting_text_from_tables(spark, sf_dir)
    read = Observation("lines-read")
    lines = text.frame.observe(read, F.count(F.lit(1)).alias("n"))
    parsed = parse_postings(lines).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    counts = {"lines": read.get["n"], "postings": parsed}
    text.discard()
    rows = ", ".join(f"('{what}', {n}L)" for what, n in counts.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS counts(what, row_count)")


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings written as text lines, scanned and parsed back.  The lines stay
    for the returned frame until ``session.discard_all``."""
    return parse_postings(posting_text_from_tables(spark, sf_dir).frame)


def questions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return questions(_postings(spark, sf_dir))


def answers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answers(_postings(spark, sf_dir))


def pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return question_answer_pairs(_postings(spark, sf_dir))


def grouped_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_postings(_postings(spark, sf_dir))


def grouped_count_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_posting_count(_postings(spark, sf_dir))


def scored_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_postings(_postings(spark, sf_dir))


def first_language_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every question's tag and its language index (null when unlisted)."""
    q = questions(_postings(spark, sf_dir)).select("id", "tags")
    return with_language_index(q, DEFAULT_PARAMS.langs)


def label_vectors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir)


def weighted_points_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_points(_vectors(spark, sf_dir))


def stratified_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_sample(_vectors(spark, sf_dir), DEFAULT_PARAMS)


def global_sample_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_sample(_vectors(spark, sf_dir, MIXED_PARAMS), MIXED_PARAMS)


def nearest_center_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its nearest initial center and squared distance."""
    vectors = _vectors(spark, sf_dir)
    return assign_clusters(vectors, initial_centers(vectors, DEFAULT_PARAMS))


def _one_step(spark: SparkSession, sf_dir: str, step) -> DataFrame:
    """A result of k rows from the vectors and their sample.  The vectors are
    written once, so that sample and step both read the file."""
    vectors = materialize(_vectors(spark, sf_dir), "vectors")
    return settle(step(vectors.frame, initial_centers(vectors.frame, DEFAULT_PARAMS)), vectors)


def center_update_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_step(spark, sf_dir, center_update)


def center_shift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_step(spark, sf_dir, lambda v, c: center_shift(v, c, DEFAULT_PARAMS.eta))


def _clustered(spark: SparkSession, sf_dir: str, params: ClusterParams = DEFAULT_PARAMS,
               exact_percent: bool = True):
    return cluster_points(prepare_points(_postings(spark, sf_dir), params), params, exact_percent)


def kmeans_trace_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = _clustered(spark, sf_dir)
    outcome.discard()  # the trace is built from the k-row results
    return outcome.kmeans.trace_frame(spark)


def kmeans_centers_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = _clustered(spark, sf_dir)
    outcome.discard()
    return centers_frame(spark, outcome.centers)


def cluster_language_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcome = _clustered(spark, sf_dir)
    return outcome.settle(cluster_language_counts(outcome.points.weighted, outcome.centers, DEFAULT_PARAMS))


def cluster_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir).settle()


def cluster_summary_initial_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary at the sampled centers: what the original job reports, since
    its k-means never moves the centers."""
    points = prepare_points(_postings(spark, sf_dir), DEFAULT_PARAMS)
    start = initial_centers(points.vectors, DEFAULT_PARAMS)
    return settle(cluster_summary(points.weighted, start, DEFAULT_PARAMS),
                  points.vectors_table, points.weighted_table)


def cluster_summary_mixed_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir, MIXED_PARAMS).settle()


def cluster_percent_truncated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clustered(spark, sf_dir, MIXED_PARAMS, exact_percent=False).settle()


def cluster_report_lines_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_lines(_clustered(spark, sf_dir).settle())


def scored_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every question: is its own score also its best answer's score?"""
    postings = _postings(spark, sf_dir)
    wanted = questions(postings).select("id", F.col("score").alias("ranking")).distinct()
    return lookup_rankings(scored_postings(postings), wanted)


def end_to_end_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines -> parse -> pair -> score -> vectors -> k-means -> summary."""
    text = posting_text_from_tables(spark, sf_dir)
    summary = cluster_lines(text.frame, DEFAULT_PARAMS).settle()
    text.discard()
    return summary


QUERIES: dict[str, Query] = {
    "raw_posting_count": raw_posting_count,
    "raw_postings": raw_postings,
    "questions": questions_query,
    "answers": answers_query,
    "question_answer_pairs": pairs_query,
    "grouped_postings": grouped_query,
    "grouped_posting_count": grouped_count_query,
    "scored_postings": scored_query,
    "scored_question_lookup": scored_lookup_query,
    "first_language_index": first_language_index_query,
    "label_vectors": label_vectors_query,
    "weighted_points": weighted_points_query,
    "stratified_sample": stratified_sample_query,
    "global_sample": global_sample_query,
    "nearest_center": nearest_center_query,
    "center_update": center_update_query,
    "center_shift": center_shift_query,
    "kmeans_trace": kmeans_trace_query,
    "kmeans_centers": kmeans_centers_query,
    "cluster_language_counts": cluster_language_counts_query,
    "cluster_summary": cluster_summary_query,
    "cluster_summary_initial": cluster_summary_initial_query,
    "cluster_summary_mixed": cluster_summary_mixed_query,
    "cluster_percent_truncated": cluster_percent_truncated_query,
    "cluster_report_lines": cluster_report_lines_query,
    "qa_clusters_end_to_end": end_to_end_query,
}
