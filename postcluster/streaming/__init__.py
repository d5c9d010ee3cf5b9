"""Streaming.

The job is a bounded batch: it has no stream source, watermark, time window
or state, and nothing here adds one.  The posting parser is a stateless
filter and projection, so the same text source and parser also run on a
stream of posting files (``read_posting_stream``); the pairing, sampling and
k-means steps stay batch jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from postcluster.sources.text import parse_postings


def read_posting_stream(spark: SparkSession, path: str) -> DataFrame:
    """Posting files arriving under ``path`` as a streaming posting table.

    A malformed line fails the micro-batch that reads it, as in batch.
    """
    return parse_postings(spark.readStream.text(path))


__all__ = ["read_posting_stream"]
