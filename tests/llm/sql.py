"""Run a query's DuckDB SQL and compare rows."""

from __future__ import annotations

import duckdb

TABLES = "documents embeddings pages benchmark labels conversations".split()


def duck_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted(map(repr, (tuple(v for _, v in sorted(zip(names, r))) for r in cur.fetchall()))), sorted(names)


def same_rows(df, sql, sf_dir):
    want, names = duck_rows(sql, sf_dir)
    assert sorted(df.columns) == names
    got = sorted(repr(tuple(r[n] for n in names)) for r in df.collect())
    assert got == want
