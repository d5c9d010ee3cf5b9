"""What the trained operators share: labelled rows and the split by id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on at most (a documented bound of the
#: fit alone; every row is scored).  The rows with the smallest hash of their
#: id are taken, so the choice does not depend on the layout of the tables.
FIT_ROWS = 12_000


def held_out(doc_id: Column) -> Column:
    """True for the rows that no fit may see: crc32 of the id as text,
    modulo 5, is 0.  A null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int = FIT_ROWS) -> DataFrame:
    """``text, y`` of up to ``bound`` labelled rows outside the held-out fold.

    A label other than 0 and 1 is no label; an id with several labels has
    their maximum, and of an id with several texts the first in order counts.
    The ids are chosen from the labels alone, so the join meets a table of
    ``bound`` rows.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return texts.join(F.broadcast(known), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", "y")
