from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from postcluster.llm import collocations as co
from postcluster.llm.catalog import op11_collocations, oracle_queries
from postcluster.session import open_folders
from tests.llm.conftest import SF
from tests.llm.sql import same_rows

SCHEMA = "text string, lang string"


def pieces(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def counts(rows, longest=5):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for ws in pieces(text):
            n[lang] += len(ws)
            f.update((lang, tuple(ws[i:i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    return f, n


def brute(rows, least, top=2000, covered=100):
    f, n = counts(rows)
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    dropped = set()
    for (lang, ws), a in cand.items():
        for i in range(len(ws)):
            for j in range(i + 2, len(ws) + 1):
                if j - i < len(ws) and 100 * a >= covered * f[lang, ws[i:j]]:
                    dropped.add((lang, ws[i:j]))
    found = []
    for (lang, ws), a in cand.items():
        if (lang, ws) not in dropped:
            cuts = [(1000 * a * n[lang] // (f[lang, ws[:k]] * f[lang, ws[k:]]), k) for k in range(1, len(ws))]
            score, k = min(cuts)
            found.append((lang, -score, -a, " ".join(ws).encode(), f[lang, ws[:k]], f[lang, ws[k:]]))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "日本", "a.b", "x\x00y"]
    fixed = ["New York City", "In  spite\tof", "a a a a a a a"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(120))
    rows = [(None, "en"), ("", "en"), (" \t", None), ("...!!\n", "de"), ("One", "de"), ("z " * 3000, "en"), ("q r " * 900, "und")]
    for i in range(250):
        body = [rng.choice(vocabulary[:8] if i % 3 else vocabulary) for _ in range(rng.randrange(1, 60))]
        for _ in range(3):
            body.insert(rng.randrange(len(body) + 1), rng.choice(fixed))
            body.insert(rng.randrange(len(body) + 1), rng.choice([".", " ,; ", "\n", "?!"]))
        rows.append((rng.choice([" ", "  ", "\t"]).join(body), rng.choice(["en", "en", "de", None, "und"])))
        if i % 4 == 0:
            rows.append((passage + rng.choice(["", ".", " end"]), "en"))
    return rows + rows[-3:]


@pytest.mark.parametrize("modulus", [1, 4, 16])
def test_chunks_hold_every_phrase_once(modulus):
    rows = corpus()
    of, last, chunk = co.parse(pa.array([t for t, _ in rows], pa.string()), 4, modulus)
    got = Counter()
    for end, text in zip(last.tolist(), chunk.to_pylist()):
        ws = text.split(" ")
        for i in range(len(ws) if end else len(ws) - 4):
            for k in range(1, 6):
                run = tuple(ws[i:i + k])
                if len(run) == k and "\n" not in run:
                    got[run] += 1
    want = Counter()
    for (_, ws), n in counts([(t, "x") for t, _ in rows])[0].items():
        want[ws] += n
    assert got == want


@pytest.mark.parametrize("how", [{}, {"modulus": 1}, {"modulus": 1000, "top": 7, "covered": 60}])
def test_equals_plain_counts(spark, how, monkeypatch):
    if how.get("modulus") == 1:
        monkeypatch.setattr(co, "MIN_FILTER_BITS", 512)  # a full filter lets everything through
        monkeypatch.setattr(co, "MAX_FILTER_BITS", 512)
        monkeypatch.setattr(co, "COUNT_BYTES", 1000)
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in co.collocations(df, least=8, **how).collect())
    want = brute(rows, 8, how.get("top", 2000), how.get("covered", 100))
    assert got == want and len(want) > 15 and {r[0] for r in want} == {"en", "de", "und"}


def test_numbers_beyond_64_bits(spark):
    big = 3_000_000_000_000
    phrases = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2)],
                                    "lang string, phrase string, k int, a long")
    totals = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(co, "frequent_phrases", lambda *a: (phrases, totals))
        row = co.collocations(spark.createDataFrame([], SCHEMA)).collect()[0]
    assert row.score == 1000 * big * 9 * big // ((big + 1) * (big + 2)) and 1000 * big * 9 * big > 1 << 64


def test_edge_tables_and_deleted_dictionary(spark):
    before = open_folders(spark)
    assert co.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert co.collocations(spark.createDataFrame([(None, None), ("", "en"), ("one. two", "en")], SCHEMA)).collect() == []
    clash = spark.createDataFrame([("a b", "en", 1, "n")] * 100, SCHEMA + ", n int, phrase string")
    assert [tuple(r) for r in co.collocations(clash).collect()] == [("en", 1, "a b", 100, 100, 100, 200, 2000)]
    assert not any("chunks-" in p for p in open_folders(spark) - before)


def test_query_equals_its_sql(spark):
    same_rows(op11_collocations(spark, SF), oracle_queries()["op11_collocations"], SF)
