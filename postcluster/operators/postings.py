"""Question and answer filters over the posting table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1."""
    return postings.where(F.col("posting_type") == F.lit(1))


def answers(postings: DataFrame) -> DataFrame:
    """Postings of type 2 that name the question they answer."""
    return postings.where((F.col("posting_type") == F.lit(2)) & F.col("parent_id").isNotNull())
