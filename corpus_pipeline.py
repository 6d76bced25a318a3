"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next.

Toxic documents go; of each group of near duplicates one document stays; secrets are blanked out; the sources are
mixed to their target weights, in training order, with repeats; the texts are encoded and decoded.
"""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinweave.llm import byte_bpe, curriculum, jaccard_join, secret_scan, toxicity  # noqa: E402
from kinweave.llm.common import table  # noqa: E402
from kinweave.session import cut  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def blank_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = secret_scan.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secret_scan.redacted(docs, ranks=secret_scan.ranked(known, secret_scan.learned(docs)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.training_order(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_duplicates),
    ("secret_scan", blank_secrets),
    ("curriculum_mix", mix_sources),
    ("byte_bpe", encode),
]

# The classifier and the path sampling are not statements of SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; every result is written to the shared folder before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
