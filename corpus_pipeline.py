"""A training corpus in five stages, from ``documents`` to packed sequences.

Each stage takes what the one before it kept, as a table read from Parquet. All but
the last return the columns of their input. Documents that are predicted toxic go;
of equal texts (white space aside) the longest stays; of each group of near copies
one stays; documents are repeated or left out so that sources meet their weights; and
what is left is cut into sequences of at most 4096 ids. Rows with null or empty texts
go through (the mix takes those of size 0 with the complete epochs).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corploom.llm.exact_dedup import keep_exact
from corploom.llm.frames import table
from corploom.llm.mixing import mixed_rows
from corploom.llm.near_dedup import keep_near
from corploom.llm.slack_packing import pack_slack
from corploom.llm.toxicity import drop_toxic
from corploom.session import stage

TOKENIZER = "word_bpe_49k.json"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows not predicted toxic; trained on the labels, less the held-out fifth."""
    return drop_toxic(docs, spark.read.parquet(table(sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return keep_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies."""
    return keep_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix has it."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    return pack_slack(docs, public_tokenizers.path(TOKENIZER), end_id=1).drop("ids")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("minhash_near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

ORACLE_SQL = None  # a trained classifier and a greedy packing; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what each returns but the last is staged."""
    docs = spark.read.parquet(table(sf_dir, "documents"))
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
