from __future__ import annotations

import math

import public_tokenizers

from postcluster.llm import token_counts as tc
from postcluster.llm.catalog import op3_token_counts
from tests.llm.conftest import SF, clashing_words

PATH = public_tokenizers.path("piece_bpe_32k.model")


def brute(word, pieces, floor):
    """Best (score, -pieces) over all cuts, one word at a time."""
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
    for at in range(1, len(word) + 1):
        options = [(best[b][0] + pieces[word[b:at]], best[b][1] - 1) for b in range(at) if word[b:at] in pieces]
        if word[at - 1] not in pieces:
            n = len(word[at - 1].encode())
            options.append((best[at - 1][0] + n * floor, best[at - 1][1] - n))
        best[at] = max(options)
    return -best[-1][1], best[-1][0]


def expected(text, pieces, floor):
    words = [w for w in (text or "").encode().split()]
    found = [brute(tc.WORD_MARK + w.decode(), pieces, floor) for w in words]
    return len(words), sum(f[0] for f in found), sum(f[1] for f in found)


def test_counts_equal_a_plain_search(spark, docs):
    pieces = tc.Pieces.read(PATH).score
    floor = min(pieces.values()) - tc.UNKNOWN_BELOW
    texts = [None, "", "  \n", "the theory of thermodynamics", "日本 \U0001f600 x", "a" * 300, "the the", "the the", *clashing_words()]
    got = tc.token_counts(docs(texts), PATH).orderBy("_row.doc_id").collect()
    assert [(r.n_words, r.n_tokens, r.score) for r in got] == [expected(t, pieces, floor) for t in texts]


def test_query_over_the_whole_table(spark):
    pieces = tc.Pieces.read(PATH).score
    floor = min(pieces.values()) - tc.UNKNOWN_BELOW
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: tuple(r)[1:] for r in op3_token_counts(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows[::5]:
        assert got[r.doc_id] == expected(r.text, pieces, floor)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "hi", "x")], "score long, text string, n_tokens string")
    assert tc.token_counts(df, PATH).collect()[0]._row.n_tokens == "x"
    assert tc.token_counts(df.limit(0), PATH).collect() == []
