"""Fixed-size samples of the vectors, used as initial k-means centers.

The draw is a seeded hash of the question id, ``md5("<seed>:<id>")``: every
row gets the same rank whatever the partitioning or task order, so the
sample is reproducible and equal to the DuckDB oracle's.

* by language (spread >= 500): the first ``kernels / len(langs)`` rows of
  each language in hash order.  ``row_number() <= k`` over a window
  partitioned by ``x`` is planned with a ``WindowGroupLimit`` before the
  shuffle, so each task ships at most k rows per language even when one
  language holds most of the data.
* overall (spread < 500): the first ``kernels`` rows in hash order,
  planned as ``TakeOrderedAndProject`` (a per-task top-k, then a merge of
  at most tasks * k rows).

Clusters are numbered from 0 in ``(x, rank)`` order (by language) or in
hash order (overall).  The numbering window runs over at most ``kernels``
rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postcluster.functions.geometry import Point
from postcluster.params import DEFAULT_PARAMS, ClusterParams


def sample_order(seed: int, id_col: str = "id") -> Column:
    """Hex md5 of ``"<seed>:<id>"``; ascending order is the draw order."""
    return F.md5(F.concat(F.lit(f"{int(seed)}:"), F.col(id_col).cast("string")))


def stratified_sample(vectors: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    """``cluster, x, y, id, rank``: ``per_language`` rows from each language."""
    per = params.per_language
    by_lang = Window.partitionBy("x").orderBy("draw", "id", "y")
    ranked = (
        vectors.select("id", "x", "y", sample_order(params.seed).alias("draw"))
        .withColumn("rank", F.row_number().over(by_lang))
        .where(F.col("rank") <= F.lit(per))
    )
    return ranked.select(
        (F.row_number().over(Window.orderBy("x", "rank")) - F.lit(1)).cast("int").alias("cluster"),
        "x",
        "y",
        "id",
        F.col("rank").cast("int").alias("rank"),
    )


def global_sample(vectors: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    """``cluster, x, y, id, rank``: ``kernels`` rows regardless of language."""
    top = (
        vectors.select("id", "x", "y", sample_order(params.seed).alias("draw"))
        .orderBy("draw", "id", "x", "y")
        .limit(params.kernels)
    )
    numbered = top.withColumn("rank", F.row_number().over(Window.orderBy("draw", "id", "x", "y")))
    return numbered.select(
        (F.col("rank") - F.lit(1)).cast("int").alias("cluster"),
        "x",
        "y",
        "id",
        F.col("rank").cast("int").alias("rank"),
    )


def sample_vectors(vectors: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    """The sample the job uses: by language unless the spread is below 500."""
    if params.samples_by_language:
        return stratified_sample(vectors, params)
    return global_sample(vectors, params)


def initial_centers(vectors: DataFrame, params: ClusterParams = DEFAULT_PARAMS) -> list[Point]:
    """Collect the sample (at most ``kernels`` rows) as centers, checked.

    Fails when kernels is not a multiple of the language count, when a
    language present in the data has fewer than ``per_language`` rows, or
    when the sample does not hold exactly ``kernels`` rows.
    """
    if params.samples_by_language:
        per = params.per_language  # raises on an uneven split
    # At most ``kernels`` rows: sorted here rather than by a distributed sort.
    rows = sorted(sample_vectors(vectors, params).select("cluster", "x", "y").collect(),
                  key=lambda r: r["cluster"])
    if params.samples_by_language:
        counts: dict[int, int] = {}
        for r in rows:
            counts[r["x"]] = counts.get(r["x"], 0) + 1
        short = sorted(x for x, c in counts.items() if c < per)
        if short:
            raise ValueError(f"languages at x={short} have fewer than {per} rows to sample")
    if len(rows) != params.kernels:
        raise ValueError(f"sample holds {len(rows)} rows, expected {params.kernels}")
    return [(int(r["x"]), int(r["y"])) for r in rows]
