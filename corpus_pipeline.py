"""Training-corpus pipeline over ``documents``: classify, dedup, cut repeats, redact secrets, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result
as Parquet in the shared folder and the next stage reads it.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlet.llm.classifier import held_out, keep_good
from martlet.llm.common import read_table, stored
from martlet.llm.near_documents import keep_one
from martlet.llm.packing import pack_documents
from martlet.llm.secrets import redact_secrets
from martlet.llm.suffix_dedup import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more; it learns from the labels that are not held out."""
    return keep_good(docs, read_table(spark, sf_dir, "labels").filter(~held_out()))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least doc_id."""
    return keep_one(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that stand more than once."""
    return without_repeats(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every reported secret masked."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near dedup", near_dedup),
    ("suffix dedup", suffix_dedup),
    ("secret scan", secret_scan),
    ("packing", packing),
]

#: SQL cannot express the stages; test_pipeline_stages in tests/llm holds each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
