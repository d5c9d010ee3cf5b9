"""DataFrame -> DataFrame operators of the clustering job."""

from postcluster.operators.kmeans import (
    KMeansResult,
    assign_clusters,
    center_shift,
    center_update,
    centers_frame,
    cluster_sums,
    kmeans,
    lloyd_step,
)
from postcluster.operators.pairing import (
    answer_half,
    contains_ranking,
    grouped_posting_count,
    grouped_postings,
    join_halves,
    lookup_rankings,
    posting_reduction,
    question_half,
    question_answer_pairs,
    scored_from_reduction,
    scored_postings,
)
from postcluster.operators.postings import answers, questions
from postcluster.operators.sampling import (
    global_sample,
    initial_centers,
    sample_order,
    sample_vectors,
    stratified_sample,
)
from postcluster.operators.summary import (
    cluster_language_counts,
    cluster_summary,
    print_report,
    report_lines,
    write_report,
)
from postcluster.operators.vectors import (
    ensure_weighted,
    label_vectors,
    weighted_points,
    with_language_index,
)

__all__ = [
    "KMeansResult",
    "answers",
    "assign_clusters",
    "center_shift",
    "center_update",
    "centers_frame",
    "cluster_language_counts",
    "cluster_summary",
    "cluster_sums",
    "answer_half",
    "contains_ranking",
    "ensure_weighted",
    "global_sample",
    "grouped_posting_count",
    "grouped_postings",
    "initial_centers",
    "kmeans",
    "label_vectors",
    "lloyd_step",
    "join_halves",
    "lookup_rankings",
    "posting_reduction",
    "question_half",
    "print_report",
    "question_answer_pairs",
    "questions",
    "report_lines",
    "sample_order",
    "sample_vectors",
    "scored_from_reduction",
    "scored_postings",
    "stratified_sample",
    "weighted_points",
    "with_language_index",
    "write_report",
]
