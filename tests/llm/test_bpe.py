from __future__ import annotations

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

from postcluster.llm import bpe
from postcluster.llm.catalog import op1_bpe
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "a" * 5000, "<|endoftext|>x <|endoftext|>", "don't  we'll\n\n ok ", "日本 😀 né 123 ½",
       "\x1c\x85  x", "same", "same"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(texts):
    public = Tokenizer.from_file(PATH)
    public.no_truncation()
    public.no_padding()
    for e in public.encode_batch([t or "" for t in texts], add_special_tokens=False):
        yield len(e.ids), sha(",".join(map(str, e.ids))), sha(public.decode(e.ids, skip_special_tokens=False))


def test_round_trip_equals_the_public_library(spark, docs):
    got = bpe.round_trip(docs(ODD), PATH).orderBy("_row.doc_id").collect()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got] == list(expected(ODD))


def test_query_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = op1_bpe(spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(r.doc_id, *e) for r, e in zip(rows, expected([r.text for r in rows]))]


def test_encode_then_decode_gives_the_text(spark, docs):
    encoded = bpe.encode(docs(ODD), PATH)
    back = bpe.decode(encoded, PATH).orderBy("_row.doc_id").collect()
    assert [r.decoded for r in back] == [t or "" for t in ODD]


def test_clashing_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, "hi there", 7, "z")], "ids long, text string, n_tokens int, _row string")
    row = bpe.encode(df, PATH).collect()[0]
    assert row._row.asDict() == {"ids": 1, "text": "hi there", "n_tokens": 7, "_row": "z"}
    assert len(row.ids) == 2
    assert bpe.round_trip(df.limit(0), PATH).collect() == []
