"""Pairing and best-score (the original suite's grouping/scoring tests)."""

from __future__ import annotations

from postcluster.operators.pairing import (
    contains_ranking,
    grouped_posting_count,
    grouped_postings,
    question_answer_pairs,
    scored_postings,
)
from postcluster.sources.text import read_postings

# Golden questions and best scores; the answers are made up: one with the
# best score and one lower for each question.
GOLDEN = [
    ("1,6,,,140,CSS", 67),
    ("1,42,,,155,PHP", 89),
    ("1,72,,,16,Ruby", 3),
    ("1,126,,,33,Java", 30),
    ("1,174,,,38,C#", 20),
]


def golden_lines():
    lines = []
    next_id = 1000
    for question, best in GOLDEN:
        qid = question.split(",")[1]
        lines.append(question)
        lines.append(f"2,{next_id},,{qid},{best}")
        lines.append(f"2,{next_id + 1},,{qid},{best - 5}")
        next_id += 2
    return lines


def test_golden_scored_rows(spark, lines_file):
    scored = scored_postings(read_postings(spark, lines_file(golden_lines()))).cache()
    for question, best in GOLDEN:
        qid = int(question.split(",")[1])
        assert contains_ranking(scored, qid, best)
        assert not contains_ranking(scored, qid, best - 5)
    assert scored.count() == len(GOLDEN)
    scored.unpersist()


def test_golden_grouped_count(spark, lines_file):
    postings = read_postings(spark, lines_file(golden_lines()))
    assert grouped_posting_count(postings).first()["groups"] == len(GOLDEN)
    assert grouped_postings(postings).count() == len(GOLDEN)


def test_duplicate_questions(postings_df):
    same = (1, 5, None, None, 10, "Java")
    other = (1, 5, None, None, 11, "Java")
    answers = [(2, 100, None, 5, 7, None), (2, 101, None, 5, -2, None)]
    exact_copies = scored_postings(postings_df([same, same] + answers))
    assert [tuple(r) for r in exact_copies.collect()] == [same + (7,)]
    distinct = scored_postings(postings_df([same, other] + answers))
    assert sorted(tuple(r) for r in distinct.collect()) == sorted([same + (7,), other + (7,)])


def test_duplicate_ids_multiply_pairs(postings_df):
    rows = [(1, 5, None, None, 10, "Java"), (1, 5, None, None, 11, "Java"),
            (2, 100, None, 5, 7, None), (2, 101, None, 5, 3, None), (2, 102, None, 5, 1, None)]
    df = postings_df(rows)
    assert question_answer_pairs(df).count() == 6
    g = grouped_postings(df).first()
    assert (g["question_postings"], g["answers"], g["pairs"]) == (2, 3, 6)
    assert (g["min_answer_id"], g["max_answer_id"], g["high_score"]) == (100, 102, 7)


def test_orphans_and_unanswered_drop_out(postings_df):
    rows = [
        (1, 1, None, None, 3, "Java"),      # answered
        (1, 2, None, None, 3, "Java"),      # unanswered
        (2, 10, None, 1, 4, None),          # answer to 1
        (2, 11, None, 99, 4, None),         # orphan: parent does not exist
        (2, 12, None, None, 4, None),       # answer without parent
        (3, 13, None, 1, 4, None),          # other type, parent 1: ignored
    ]
    df = postings_df(rows)
    pairs = question_answer_pairs(df).collect()
    assert [(r["question_id"], r["a_id"]) for r in pairs] == [(1, 10)]
    assert [r["id"] for r in scored_postings(df).collect()] == [1]


def test_negative_best_score(postings_df):
    rows = [(1, 1, None, None, 3, "Java"), (2, 10, None, 1, -4, None), (2, 11, None, 1, -9, None)]
    assert scored_postings(postings_df(rows)).first()["high_score"] == -4


def test_grouped_posting_count_edges(postings_df):
    rows = [
        (1, 1, None, None, 3, "Java"), (1, 1, None, None, 4, "Java"),  # duplicate id, answered
        (1, 2, None, None, 3, "Java"),                                  # unanswered
        (3, 3, None, None, 0, None), (2, 30, None, 3, 1, None),         # answer to a non-question
        (2, 10, None, 1, 5, None), (2, 11, None, 1, 6, None),
        (2, 12, None, 99, 6, None),                                     # orphan answer
        (2, 13, None, None, 6, None),                                   # answer without parent
    ]
    df = postings_df(rows)
    assert grouped_posting_count(df).first()["groups"] == 1
    g = [tuple(r) for r in grouped_postings(df).collect()]
    assert g == [(1, 2, 2, 4, 10, 11, 6)]
    assert question_answer_pairs(df).count() == 4


def test_lookup_rankings(spark, postings_df):
    from postcluster.operators.pairing import lookup_rankings

    scored = scored_postings(postings_df([
        (1, 6, None, None, 140, "CSS"), (1, 6, None, None, 141, "CSS"), (1, 9, None, None, 1, None),
        (2, 7, None, 6, 67, None), (2, 8, None, 6, 3, None)]))
    wanted = spark.createDataFrame([(6, 67), (6, 3), (9, 1), (None, 67), (6, None)], "id int, ranking int")
    got = {(r.id, r.ranking): r.found for r in lookup_rankings(scored, wanted).collect()}
    assert got == {(6, 67): True, (6, 3): False, (9, 1): False, (None, 67): False, (6, None): False}
