"""Written intermediates: durable files under spark.checkpoint.dir, deleted when done."""

from __future__ import annotations

import os

import pytest

from postcluster.plans.clustering import cluster_postings
from postcluster.session import checkpoint_root, materialize
from postcluster.sources.tables import postings_from_tables
from tests.conftest import SF_SMALL


def _local(path: str) -> str:
    return path.removeprefix("file:")


def test_materialize_writes_under_checkpoint_dir_and_discards(spark):
    written = materialize(spark.range(10), "probe")
    assert written.path.startswith(checkpoint_root(spark).rstrip("/"))
    assert written.frame.count() == written.rows == 10
    path = written.path
    assert os.path.exists(_local(path))
    written.discard()
    assert not os.path.exists(_local(path))
    assert written.path is None


def test_clustering_keeps_only_what_the_summary_reads(spark):
    outcome = cluster_postings(postings_from_tables(spark, SF_SMALL))
    assert outcome.points.vectors_table.path is None  # deleted after the sample
    weighted_path = outcome.points.weighted_table.path
    assert os.path.exists(_local(weighted_path))
    assert outcome.summary.count() > 0
    outcome.discard()
    assert not os.path.exists(_local(weighted_path))


def test_without_checkpoint_dir_writing_is_an_error(spark, monkeypatch):
    import postcluster.session as session
    from postcluster.plans.catalog import QUERIES

    monkeypatch.setattr(session, "_configured_root", lambda _spark: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.materialize(spark.range(5), "probe")
    for name in ("raw_posting_count", "cluster_summary"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            QUERIES[name](spark, SF_SMALL)


def test_every_query_leaves_the_shared_folder_empty(spark):
    from postcluster.plans.catalog import QUERIES
    from postcluster.session import discard_all

    folder = os.path.join(_local(checkpoint_root(spark)), "postcluster")
    discard_all(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    for name, query in QUERIES.items():
        query(spark, SF_SMALL).write.format("noop").mode("overwrite").save()
        left = {p.rsplit("-", 1)[0] for p in set(os.listdir(folder)) - before}
        assert left <= {"posting-lines"}, name  # only what a lazy result still reads
        discard_all(spark)
        assert set(os.listdir(folder)) <= before, name


def test_delete_errors_are_raised(spark, monkeypatch):
    import postcluster.session as session

    written = materialize(spark.range(3), "probe")

    def refuse(_spark, path):
        raise OSError(path)

    with monkeypatch.context() as m:
        m.setattr(session, "_delete", refuse)
        with pytest.raises(OSError):
            written.discard()
    assert written.path is not None
    written.discard()


def test_session_takes_the_master_it_is_given(monkeypatch):
    import postcluster.__main__ as main
    import postcluster.session as session

    class Builder:
        def __init__(self):
            self.seen = {}

        def appName(self, name):
            return self.config("name", name)

        def master(self, master):
            return self.config("master", master)

        def config(self, key, value):
            self.seen[key] = value
            return self

        def getOrCreate(self):
            return self

    class Session:
        builder = None

    def options(*args, **how):
        Session.builder = Builder()
        return session.open_session(*args, **how).seen

    monkeypatch.setattr(session, "SparkSession", Session)
    assert "master" not in options()
    assert options(master="local[2]")["master"] == "local[2]"
    assert options(extra={"spark.checkpoint.dir": "/shared"})["spark.checkpoint.dir"] == "/shared"
    assert main.arguments(["--debug", "p"]) == main.Arguments("p", debug=True)
    assert main.arguments(["--checkpoint-dir", "/s", "--master", "local[1]", "p"]) == main.Arguments(
        "p", checkpoint_dir="/s", master="local[1]")
    with pytest.raises(SystemExit):
        main.arguments([])


def test_prepared_vectors_equal_the_lazy_plan(postings_df):
    from postcluster.operators.pairing import scored_postings
    from postcluster.operators.vectors import label_vectors
    from postcluster.plans.clustering import prepare_points

    rows = [
        (1, 1, None, None, 3, "Java"), (1, 2, None, None, 4, "COBOL"), (1, 3, None, None, 5, None),
        (1, 4, None, None, 6, "java"), (1, 1, None, None, 3, "Java"), (1, 5, 9, None, 1, "Scala"),
        (2, 10, None, 1, 7, None), (2, 11, None, 2, 8, None), (2, 12, None, 3, 9, None),
        (2, 13, None, 4, -1, None), (2, 14, None, 5, 2, None), (2, 15, None, 5, 6, None),
        (3, 16, None, 5, 99, None),
    ]
    df = postings_df(rows)
    points = prepare_points(df)
    got = sorted(tuple(r) for r in points.vectors.collect())
    assert got == sorted(tuple(r) for r in label_vectors(scored_postings(df)).collect())
    assert got == [(1, 50000, 7), (5, 500000, 6)]
    points.discard()
