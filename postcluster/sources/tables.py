"""Postings derived from the test tables (orders, lineitem, supplier).

The original job's input file is not available, so questions come from
``orders``, answers from ``lineitem`` and unrelated postings from
``supplier``.  The mapping (also written out as SQL for the DuckDB oracle)
is a pure projection of each table, so the three scans are map-only and
their union needs no shuffle.

| column | questions (orders) | answers (lineitem) | other (supplier) |
| --- | --- | --- | --- |
| posting_type | 1 | 2 | 3 |
| id | o_orderkey | 10000000 + l_orderkey*8 + l_linenumber | 90000000 + s_suppkey |
| accepted_answer | 10000001 + o_orderkey*8 if o_orderkey % 3 = 0 | null | null |
| parent_id | null | null if l_partkey % 50 = 1; 5000000 + l_orderkey if = 2; else l_orderkey | null |
| score | floor(o_totalprice / 10000) | l_quantity - 10 | 0 |
| tags | by o_custkey % 17: null if 16, 'COBOL' if 15, else langs[m] | null | null |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postcluster.functions.language import language_array
from postcluster.params import LANGUAGES
from postcluster.session import Written, write_lines
from postcluster.sources.text import POSTING_COLUMNS, posting_lines


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_int():
    return F.lit(None).cast("int")


def question_postings(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    tag_slot = F.col("o_custkey") % F.lit(17)
    tags = (
        F.when(tag_slot == 16, F.lit(None).cast("string"))
        .when(tag_slot == 15, F.lit("COBOL"))
        .otherwise(F.get(language_array(LANGUAGES), tag_slot.cast("int")))
    )
    return orders.select(
        F.lit(1).alias("posting_type"),
        key.cast("int").alias("id"),
        F.when(key % 3 == 0, (F.lit(10000001) + key * 8).cast("int")).alias("accepted_answer"),
        _null_int().alias("parent_id"),
        F.floor(F.col("o_totalprice") / F.lit(10000)).cast("int").alias("score"),
        tags.alias("tags"),
    )


def answer_postings(lineitem: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    slot = F.col("l_partkey") % F.lit(50)
    parent = (
        F.when(slot == 1, _null_int())
        .when(slot == 2, (F.lit(5000000) + key).cast("int"))
        .otherwise(key.cast("int"))
    )
    return lineitem.select(
        F.lit(2).alias("posting_type"),
        (F.lit(10000000) + key * 8 + F.col("l_linenumber")).cast("int").alias("id"),
        _null_int().alias("accepted_answer"),
        parent.alias("parent_id"),
        (F.col("l_quantity") - F.lit(10)).cast("int").alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )


def other_postings(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        F.lit(3).alias("posting_type"),
        (F.lit(90000000) + F.col("s_suppkey")).cast("int").alias("id"),
        _null_int().alias("accepted_answer"),
        _null_int().alias("parent_id"),
        F.lit(0).alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )


def postings_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed postings built from the test tables (see the module table)."""
    parts = [
        question_postings(read_table(spark, sf_dir, "orders")),
        answer_postings(read_table(spark, sf_dir, "lineitem")),
        other_postings(read_table(spark, sf_dir, "supplier")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(*POSTING_COLUMNS)


def posting_lines_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same postings rendered as comma-separated text lines (``value``)."""
    return posting_lines(postings_from_tables(spark, sf_dir))


def posting_text_from_tables(spark: SparkSession, sf_dir: str) -> Written:
    """The postings as real text files: rendered once into the shared
    checkpoint folder, then scanned with ``spark.read.text`` like any posting
    file.  The caller discards them.
    """
    return write_lines(posting_lines_from_tables(spark, sf_dir), "posting-lines")
