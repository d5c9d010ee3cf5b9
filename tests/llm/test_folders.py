"""What the operators write to the shared folder is deleted."""

from __future__ import annotations

import os

import pytest

import corpus_pipeline
from postcluster.llm.catalog import QUERIES
from postcluster.llm.frames import cut, drop, keep_only, scope
from postcluster.session import checkpoint_root, open_folders
from tests.llm.conftest import SF


def files(spark):
    """All files in the shared folder."""
    root = checkpoint_root(spark).removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names}


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_a_scope_leaves_nothing(spark, name):
    before = files(spark)
    with scope(spark):
        rows = {**QUERIES, "pipeline": corpus_pipeline.run}[name](spark, SF)
        rows.write.format("noop").mode("overwrite").save()
    assert files(spark) <= before


def test_drop_and_keep(spark):
    before, there = open_folders(spark), files(spark)
    one, two, three = (cut(spark.range(n)) for n in (1, 2, 3))
    assert len(open_folders(spark) - before) == 3
    drop(one)
    keep_only(spark, before, three)
    assert len(open_folders(spark) - before) == 1 and three.count() == 3
    drop(three, two)
    assert open_folders(spark) == before and files(spark) <= there
    with pytest.raises(KeyError), scope(spark):
        cut(spark.range(4))
        raise KeyError
    assert open_folders(spark) == before


def test_pipeline_keeps_columns_of_any_name(spark):
    long = " ".join(f"q{i}" for i in range(70))
    rows = [(i, t, "en", "s", len(t), f"h{i}", i, True) for i, t in enumerate([long, long + " z", "other words here"])]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, _th string, _id long, _stay boolean")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = cut(out)
    got = {r.doc_id: (r._th, r._id, r._stay) for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert got == {0: ("h0", 0, True), 2: ("h2", 2, True)}
