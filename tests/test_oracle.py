"""Every registered query against its DuckDB SQL on the small tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from postcluster.plans.catalog import QUERIES
from postcluster.plans.oracle import oracle_queries
from tests.conftest import SF_SMALL
from tools.check_oracle import SPARK_TO_DUCK, TABLES, digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    yield con
    con.close()


def test_every_query_has_oracle_sql():
    assert set(oracle_queries()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    s_cols = df.columns
    s_types = [SPARK_TO_DUCK[f.dataType.simpleString()] for f in df.schema.fields]
    s_rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    d_rows = rel.fetchall()
    assert sorted(zip(s_cols, s_types)) == sorted(zip(rel.columns, [str(t) for t in rel.types]))
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows) == digest(rel.columns, d_rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["cluster", "lang", "lang_percent", "size", "median_score"]
    assert len(rows) > 0
