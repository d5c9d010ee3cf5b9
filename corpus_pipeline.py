"""From raw documents to token ids: the stages of a training corpus.

Each stage takes the documents that the one before kept, with the columns of
``documents``, and its decisions take effect; the last returns token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postcluster.llm import bpe, decontaminate, minhash_dedup, substring_dedup, toxicity
from postcluster.llm.frames import ROW, cut, find_code, keep_only
from postcluster.session import open_folders

#: Near copies share at least this % of their runs of so many words.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80
#: Passages of this many words or more that stand elsewhere are removed.
PASSAGE_WORDS = 50


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(f"{ROW}.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id.  Rows
    without an id all stay; of rows with one id and text one stays.  The
    columns are those that came in, whatever their names."""
    near = minhash_dedup.near_documents(docs, NEAR_SHINGLE, NEAR_PERCENT)
    stays = near.where("kept").select(F.col("id").alias("stays"), F.col("th").alias("stays_th"))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    named = packed.where(f"{ROW}.doc_id IS NOT NULL").select(
        ROW, F.col(f"{ROW}.doc_id").alias("id"), F.xxhash64(F.col(f"{ROW}.text").cast("string")).alias("th"))
    # The join's exchange of the texts serves the removal of repeated rows too.
    found = named.join(stays, (F.col("id") == F.col("stays")) & (F.col("th") == F.col("stays_th")), "left_semi")
    return found.dropDuplicates(["id", "th"]).select(ROW).union(packed.where(f"{ROW}.doc_id IS NULL")).select(f"{ROW}.*")


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that stand more than once; ``n_chars``
    follows.  A text that loses nothing stays as it is."""
    rest = [c for c in docs.columns if c != "text"]
    done = substring_dedup.remove_repeats(docs, PASSAGE_WORDS, keep=rest, as_written=True)
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col(f"{ROW}.n_chars"))
    made = {"text": F.col("kept"), "n_chars": n_chars}
    return done.select(*[made.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    done = decontaminate.find_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return done.where(F.size("leaks") == 0).select(f"{ROW}.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids instead of their texts."""
    rest = [c for c in docs.columns if c != "text"]
    done = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"), keep=rest)
    return done.select(f"{ROW}.*", "ids", F.size("ids").cast("long").alias("n_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: SQL cannot express the trained, the recursive and the tokenizing stages;
#: tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through all stages; each stage's rows are written to the
    shared folder and read again by the next, and deleted when that has
    written its own."""
    find_code(spark)
    before = open_folders(spark)
    docs = _table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = cut(docs)
            keep_only(spark, before, docs)
    return docs
