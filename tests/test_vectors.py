"""Language index, vectors and point compression."""

from __future__ import annotations

from postcluster.operators.vectors import label_vectors, weighted_points, with_language_index
from postcluster.params import ClusterParams

SCORED = "posting_type int, id int, accepted_answer int, parent_id int, score int, tags string, high_score int"


def test_language_index(spark):
    df = spark.createDataFrame(
        [(1, "JavaScript"), (2, "Groovy"), (3, "java"), (4, None), (5, "COBOL"), (6, "C#"), (7, "")],
        "id int, tags string",
    )
    got = {r["id"]: r["lang_index"] for r in with_language_index(df).collect()}
    assert got == {1: 0, 2: 14, 3: None, 4: None, 5: None, 6: 4, 7: None}


def test_unlisted_null_wrong_case_dropped(spark):
    scored = spark.createDataFrame(
        [(1, 1, None, None, 0, "Scala", 7), (1, 2, None, None, 0, "scala", 8),
         (1, 3, None, None, 0, None, 9), (1, 4, None, None, 0, "COBOL", 1),
         (1, 5, None, None, 0, "JavaScript", -3)],
        SCORED,
    )
    got = sorted(tuple(r) for r in label_vectors(scored).collect())
    assert got == [(1, 10 * 50000, 7), (5, 0, -3)]


def test_spread_parameter(spark):
    scored = spark.createDataFrame([(1, 1, None, None, 0, "PHP", 7)], SCORED)
    assert tuple(label_vectors(scored, ClusterParams(spread=1)).first()) == (1, 2, 7)


def test_weighted_points_are_exact(spark):
    v = spark.createDataFrame([(1, 0, 5), (2, 0, 5), (3, 0, 6), (4, 50000, 5)], "id int, x int, y int")
    got = sorted(tuple(r) for r in weighted_points(v).collect())
    assert got == [(0, 5, 2), (0, 6, 1), (50000, 5, 1)]


def test_first_listed_language_wins(spark):
    from postcluster.functions.language import first_language_index, language_label
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("B",), ("A",), ("C",)], "tags string")
    got = [r[0] for r in df.select(first_language_index(F.col("tags"), ("A", "B", "A"))).collect()]
    assert got == [1, 0, None]
    labels = spark.createDataFrame([(0,), (7,), (14,)], "x int").select(
        language_label(F.col("x"), ("a", "b", "c"), 7)).collect()
    assert [r[0] for r in labels] == ["a", "b", "c"]
