"""Per-cluster report: dominant language, its share, size and median score.

Works on weighted points (``x, y, n``; vectors are merged first, which is
exact).  The points are assigned to the final centers by a map-side
expression, then two small aggregates run over them:

* per ``(cluster, x)`` counts, reduced per cluster to the dominant
  language (``max(struct(count, -x))``: most questions, lowest language
  index on a tie) and the cluster size;
* per cluster the exact weighted median, ``percentile(y, 0.5, n)``, cast to
  int (an even count averages the two middle scores, truncated toward zero).

Clusters without points give no row.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postcluster.functions.geometry import Point, with_nearest_center
from postcluster.functions.language import language_label
from postcluster.operators.vectors import ensure_weighted
from postcluster.params import DEFAULT_PARAMS, REPORT_HEADER, REPORT_LINE_FORMAT, ClusterParams

SUMMARY_SCHEMA = "cluster int, lang string, lang_percent double, size bigint, median_score int"


def _assigned(points: DataFrame, centers: Sequence[Point]) -> DataFrame:
    weighted = ensure_weighted(points)
    return with_nearest_center(weighted, centers, method="array").select("cluster", "x", "y", "n")


def cluster_language_counts(points: DataFrame, centers: Sequence[Point],
                            params: ClusterParams = DEFAULT_PARAMS) -> DataFrame:
    """``cluster, lang, questions``: how many questions of each language per cluster."""
    counts = _assigned(points, centers).groupBy("cluster", "x").agg(F.sum("n").alias("questions"))
    return counts.select(
        "cluster",
        language_label(F.col("x"), params.langs, params.spread).alias("lang"),
        "questions",
    )


def cluster_summary(points: DataFrame, centers: Sequence[Point],
                    params: ClusterParams = DEFAULT_PARAMS,
                    exact_percent: bool = True) -> DataFrame:
    """``cluster, lang, lang_percent, size, median_score``, ordered by median.

    ``exact_percent=False`` reproduces the original integer arithmetic:
    ``(dominant div size) * 100``, i.e. 100.0 for a pure cluster, else 0.0.
    """
    assigned = _assigned(points, centers)
    per_lang = assigned.groupBy("cluster", "x").agg(F.sum("n").alias("cnt"))
    dominant = per_lang.groupBy("cluster").agg(
        F.max(F.struct(F.col("cnt"), (-F.col("x")).alias("neg_x"))).alias("dom"),
        F.sum("cnt").alias("size"),
    )
    medians = assigned.groupBy("cluster").agg(
        F.percentile(F.col("y"), F.lit(0.5), F.col("n")).alias("median")
    )
    dom_count = F.col("dom.cnt")
    if exact_percent:
        percent = dom_count.cast("double") * F.lit(100.0) / F.col("size").cast("double")
    else:
        percent = (F.expr("dom.cnt div size") * F.lit(100)).cast("double")
    return (
        dominant.join(medians, "cluster", "inner")
        .select(
            F.col("cluster").cast("int").alias("cluster"),
            language_label(-F.col("dom.neg_x"), params.langs, params.spread).alias("lang"),
            percent.alias("lang_percent"),
            F.col("size").cast("bigint").alias("size"),
            F.col("median").cast("int").alias("median_score"),
        )
        .orderBy("median_score", "cluster")
    )


def report_lines(summary: DataFrame) -> DataFrame:
    """The printed report as rows ``line_no int, line string``.

    Three header lines, then one line per cluster in median order, formatted
    with Java's formatter (``format_string``).  The numbering window covers
    one row per cluster, at most k rows.
    """
    spark = summary.sparkSession
    header = spark.createDataFrame(
        [(i, text) for i, text in enumerate(REPORT_HEADER)], "line_no int, line string"
    )
    order = Window.orderBy("median_score", "cluster")
    body = summary.select(
        (F.row_number().over(order) + F.lit(len(REPORT_HEADER) - 1)).cast("int").alias("line_no"),
        F.format_string(
            REPORT_LINE_FORMAT, F.col("median_score"), F.col("lang"), F.col("lang_percent"), F.col("size")
        ).alias("line"),
    )
    return header.unionByName(body)


def write_report(lines: DataFrame, path: str) -> None:
    """Write the report as one text file (it has k + 3 lines)."""
    lines.orderBy("line_no").select("line").coalesce(1).write.mode("overwrite").text(path)


def print_report(lines: DataFrame) -> None:
    """Print the report on the driver (k + 3 lines)."""
    for row in sorted(lines.collect(), key=lambda r: r["line_no"]):
        print(row["line"])
