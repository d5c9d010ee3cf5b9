"""Pairing questions with their answers, and each question's best answer score.

At scale the answers table is the big side.  Nothing here collects a
question's answers into one row: answers are reduced per question with a
partial (map-side) aggregate before any shuffle, so even a question that
holds a third of all answers costs one row per task in the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postcluster.operators.postings import answers, questions
from postcluster.sources.text import POSTING_COLUMNS


def _prefixed(prefix: str) -> list:
    return [F.col(c).alias(f"{prefix}{c}") for c in POSTING_COLUMNS]


def question_answer_pairs(postings: DataFrame, salts: int | None = None) -> DataFrame:
    """Inner equi-join ``question.id = answer.parent_id``.

    Unanswered questions and orphan answers drop out; duplicate question
    ids multiply.  Output: ``question_id`` plus the question's columns
    prefixed ``q_`` and the answer's prefixed ``a_``.  Catalyst picks the
    join strategy; with AQE a question holding many answers is split at run
    time.  ``salts`` is for sessions without AQE's skew join: each answer
    gets one of so many salts from a hash of its columns and the question
    rows are repeated once per salt, so such a question spreads over
    ``salts`` tasks.  Choose it from the executors there are.
    """
    q = questions(postings).select(*_prefixed("q_"))
    a = answers(postings).select(*_prefixed("a_"))
    if salts:
        a = a.withColumn("_salt", F.pmod(F.xxhash64(*[f"a_{c}" for c in POSTING_COLUMNS]), F.lit(salts)))
        q = q.withColumn("_q_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        condition = (q["q_id"] == a["a_parent_id"]) & (q["_q_salt"] == a["_salt"])
    else:
        condition = q["q_id"] == a["a_parent_id"]
    pairs = q.join(a, condition, "inner")
    columns = [f"q_{c}" for c in POSTING_COLUMNS] + [f"a_{c}" for c in POSTING_COLUMNS]
    return pairs.select(F.col("q_id").alias("question_id"), *columns)


def _by_question(postings: DataFrame) -> DataFrame:
    """Every question and every answer with a parent, keyed by the question
    they belong to (``id`` for a question, ``parent_id`` for an answer).

    Questions carry their columns (``q_*``), answers their id and score;
    the other side's columns are null.  Callers that do not read a column
    get it pruned by Catalyst.
    """
    is_q = F.col("posting_type") == F.lit(1)
    is_a = (F.col("posting_type") == F.lit(2)) & F.col("parent_id").isNotNull()

    def q(name: str):
        return F.when(is_q, F.col(name))

    return postings.where(is_q | is_a).select(
        F.when(is_q, F.col("id")).otherwise(F.col("parent_id")).alias("question_id"),
        is_q.alias("is_question"),
        q("accepted_answer").alias("q_accepted_answer"),
        q("parent_id").alias("q_parent_id"),
        q("score").alias("q_score"),
        q("tags").alias("q_tags"),
        F.when(is_a, F.col("id")).alias("answer_id"),
        F.when(is_a, F.col("score")).alias("answer_score"),
    )


def grouped_postings(postings: DataFrame) -> DataFrame:
    """One row per question id that has at least one question and one answer.

    The original groups the (question, answer) pairs of an id into one
    collection.  Here a group is described by its counts instead of being
    materialised: ``pairs`` is the size that collection would have
    (question postings with that id times answers to it), and the
    min/max answer ids and best score summarise its content.

    One scan, one ``groupBy(question_id)`` with a partial (map-side) step:
    no pair is formed and a hot id costs one row per task in the shuffle.
    """
    stats = _by_question(postings).groupBy("question_id").agg(
        F.count_if(F.col("is_question")).alias("question_postings"),
        F.count_if(~F.col("is_question")).alias("answers"),
        F.min("answer_id").alias("min_answer_id"),
        F.max("answer_id").alias("max_answer_id"),
        F.max("answer_score").alias("high_score"),
    )
    return stats.where((F.col("question_postings") > 0) & (F.col("answers") > 0)).select(
        "question_id",
        "question_postings",
        "answers",
        (F.col("question_postings") * F.col("answers")).alias("pairs"),
        "min_answer_id",
        "max_answer_id",
        "high_score",
    )


def grouped_posting_count(postings: DataFrame) -> DataFrame:
    """Number of question ids with at least one answer (one row, ``groups``)."""
    per_id = _by_question(postings).groupBy("question_id").agg(
        F.max(F.col("is_question")).alias("has_question"),
        F.min(F.col("is_question")).alias("lacks_answer"),
    )
    return per_id.where(F.col("has_question") & ~F.col("lacks_answer")).agg(
        F.count(F.lit(1)).alias("groups")
    )


def posting_reduction(postings: DataFrame) -> DataFrame:
    """Questions and answers in one pass, reduced per question.

    Every question maps to ``(question_id = id, its columns)`` and every
    answer with a parent to ``(question_id = parent_id, nulls, its score)``.
    One aggregate over ``(question_id, is_question, question columns)``
    removes duplicate questions and reduces each question's answers to their
    best score.  It has a partial (map-side) step, so a hot question id costs
    one row per task in the shuffle.

    The result is at most one row per distinct question plus one per
    answered id, so it is much smaller than the postings.  Writing it once
    (``session.materialize``) lets both halves of the join read it instead of
    scanning and parsing one mixed input twice.
    """
    return _by_question(postings).groupBy("question_id", "is_question", *_QUESTION).agg(
        F.max("answer_score").alias("high_score"))


_QUESTION = ("q_accepted_answer", "q_parent_id", "q_score", "q_tags")


def question_half(postings: DataFrame) -> DataFrame:
    """Distinct questions: ``question_id`` and their columns."""
    return _by_question(postings).where("is_question").select("question_id", *_QUESTION).distinct()


def answer_half(postings: DataFrame) -> DataFrame:
    """``answered_id, high_score``: one row for each answered id.

    The second grouping key never varies.  It keeps this exchange from serving
    the join on the id as well: AQE splits a hot question id only where both
    sides of the join come straight from exchanges made for it.  The price is
    a second exchange of one row for each answered id.
    """
    return _by_question(postings).where("NOT is_question").groupBy("question_id", "is_question").agg(
        F.max("answer_score").alias("high_score")).select(F.col("question_id").alias("answered_id"), "high_score")


def join_halves(qs: DataFrame, best: DataFrame, salts: int | None = None) -> DataFrame:
    """Questions (``question_id``, other columns) with their best score
    (``answered_id, high_score``, one row for each id); unanswered ones drop out.

    The question side can hold many distinct postings for one id.  AQE splits
    such an id at run time; for sessions without it, ``salts`` gives each
    question row one of so many salts from a hash of its columns and repeats
    each best-score row once per salt, so every question row still meets
    exactly one copy of its best score.
    """
    condition = F.col("question_id") == F.col("answered_id")
    columns = [c for c in qs.columns if c != "question_id"]
    if salts:
        qs = qs.withColumn("salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
        best = best.withColumn("answer_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        condition = condition & (F.col("salt") == F.col("answer_salt"))
    return qs.join(best, condition, "inner").select("question_id", *columns, "high_score")


def scored_from_reduction(reduced: DataFrame, salts: int | None = None) -> DataFrame:
    """``id, tags, high_score`` of the answered questions of a written
    :func:`posting_reduction` (its columns ``question_id, is_question, q_tags,
    high_score`` are enough)."""
    qs = reduced.where("is_question").select("question_id", "q_tags")
    best = reduced.where("NOT is_question").select(F.col("question_id").alias("answered_id"), "high_score")
    return join_halves(qs, best, salts).select(
        F.col("question_id").alias("id"), F.col("q_tags").alias("tags"), "high_score")


def scored_postings(postings: DataFrame, salts: int | None = None) -> DataFrame:
    """Each answered question with the best score among its answers.

    Questions are grouped by whole-posting equality: exact duplicate
    questions merge into one row, while different postings that share an
    id stay separate (each with the id's best answer score).  Equal to
    pairing, grouping and taking the max, without forming pairs.

    Lazy form: each half filters its own postings, so when questions and
    answers come from different sources each reads only its own.  For one
    mixed source, write the reduction first (see ``plans.clustering``).
    """
    joined = join_halves(question_half(postings), answer_half(postings), salts)
    return joined.select(
        F.lit(1).alias("posting_type"),
        F.col("question_id").alias("id"),
        *[F.col(c).alias(c.removeprefix("q_")) for c in _QUESTION],
        F.col("high_score"),
    )


def contains_ranking(scored: DataFrame, posting_id: int, ranking: int) -> bool:
    """True when some scored question has this id and this best score."""
    hit = scored.where((F.col("id") == F.lit(posting_id)) & (F.col("high_score") == F.lit(ranking)))
    return not hit.isEmpty()


def lookup_rankings(scored: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, ranking, found`` for every row of ``wanted`` (``id, ranking``):
    is there a scored question with this id and this best score?  A null id or
    ranking is never found."""
    known = scored.select(F.col("id").alias("k"), F.col("high_score").alias("h")).distinct()
    hits = wanted.select("id", "ranking").join(
        known, (F.col("id") == F.col("k")) & (F.col("ranking") == F.col("h")), "left")
    return hits.select("id", "ranking", F.col("k").isNotNull().alias("found"))
