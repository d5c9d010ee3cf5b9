"""Scored questions to 2-D points, and exact compression of equal points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.functions.language import first_language_index
from postcluster.params import DEFAULT_PARAMS, ClusterParams


def with_language_index(df: DataFrame, langs=DEFAULT_PARAMS.langs) -> DataFrame:
    """Adds ``lang_index``: 0-based index of the tag in ``langs``, else null."""
    return df.withColumn("lang_index", first_language_index(F.col("tags"), langs))


def label_vectors(scored: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    """``id, x, y``: x = language index * spread, y = best answer score.

    Questions whose tag is null or not listed are dropped.  The question
    id is kept so that sampling can be deterministic.  Map-only.
    """
    idx = first_language_index(F.col("tags"), params.langs)
    return (
        scored.select(F.col("id"), idx.alias("lang_index"), F.col("high_score"))
        .where(F.col("lang_index").isNotNull())
        .select(
            F.col("id"),
            (F.col("lang_index") * F.lit(params.spread)).cast("int").alias("x"),
            F.col("high_score").cast("int").alias("y"),
        )
    )


def weighted_points(vectors: DataFrame) -> DataFrame:
    """``x, y, n``: equal points merged, ``n`` = how many.

    Every later step (means, counts, medians) is a sum over points, so the
    weighted form gives identical results while shrinking the data to the
    number of distinct (language, score) pairs.  Partial aggregation makes
    a hot point cost one row per task in the shuffle.
    """
    return vectors.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))


def ensure_weighted(points: DataFrame) -> DataFrame:
    """Accepts vectors (``x, y``) or weighted points (``x, y, n``)."""
    if "n" in points.columns:
        return points.select("x", "y", "n")
    return weighted_points(points)
