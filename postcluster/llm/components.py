"""Connected components of a large edge table, in Spark.

Alternating star operations: every node points its larger neighbours, then its
smaller ones, at the smallest node it knows, until only stars are left.  Each round
is two aggregations and two joins over the edges that are left; the number of
rounds grows with the logarithm of the longest path.  No component is ever
gathered in one place: the neighbours of a node with very many are only
aggregated (partly before the shuffle) and joined (split at run time).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.llm.frames import cut, drop

EDGES = "a long, b long"


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The components of some edges as stars: (node, smallest node) for every
    node that is not the smallest of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low, high = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        now = np.minimum(label[low], label[high])
        before = label.copy()
        np.minimum.at(label, low, now)
        np.minimum.at(label, high, now)
        np.minimum.at(label, before[low], now)
        np.minimum.at(label, before[high], now)
        label = label[label]
        if np.array_equal(label, before):
            break
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of edges becomes the stars of its components: never more rows."""
    for batch in batches:
        if batch.num_rows:
            a, b = forest(*(batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _smallest(edges: DataFrame, key: str, value: str) -> DataFrame:
    return edges.groupBy(F.col(key).alias("k")).agg(F.min(value).alias("m"))


def _are_stars(edges: DataFrame) -> bool:
    """True if every node points at one node, which points nowhere: then each
    star is a component, and its center the smallest node."""
    if not edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return False
    ends = edges.select(F.col("a").alias("k")).distinct()
    return edges.join(ends, F.col("b") == F.col("k"), "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every node that has an
    edge ``a, b`` to a smaller node's component; a component's smallest node
    has no row.  Null ends and loops are ignored."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = cut(edges.mapInArrow(_local, EDGES).distinct())
    while not _are_stars(edges):
        # Large star: the larger neighbours of a node go to its smallest one.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both, "a", "b").withColumn("m", F.least("k", "m"))
        large = both.where("b > a").join(low, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: the smaller neighbours of a node, and itself, to its smallest one.
        low = _smallest(large, "a", "b")
        small = large.join(low, F.col("a") == F.col("k"))
        small = small.select(F.explode(F.array(F.col("a"), F.col("b"))).alias("a"), F.col("m").alias("b"))
        before, edges = edges, cut(small.where("a <> b").distinct())
        drop(before)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
