"""The registered queries of the training-data operators, one per operator, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm import (
    byte_bpe, collision_ann, cover_quantize, curriculum, importance, jaccard_join, license_scan, line_rules, line_runs,
    secret_scan, token_files, toxicity, url_model,
)
from kinweave.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = secret_scan.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return secret_scan.scan(docs, ranks=secret_scan.ranked(known, secret_scan.learned(docs)))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.write_and_check(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, n_planes=16
    )


@query
def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.per_document(table(spark, sf_dir, "documents"))


ORACLES["op7_curriculum_mix"] = curriculum.ORACLE


@query
def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.verdicts(table(spark, sf_dir, "documents"))


ORACLES["op9_line_rules"] = line_rules.ORACLE


@query
def op8_url_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_model.verdicts(table(spark, sf_dir, "pages"))


ORACLES["op8_url_model"] = url_model.ORACLE


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.train_and_score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_collision_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_ann.twentieth(table(spark, sf_dir, "embeddings"))


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op11_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_runs.per_document(table(spark, sf_dir, "documents"))


ORACLES["op11_line_runs"] = line_runs.ORACLE


@query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.per_document(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_importance"] = importance.ORACLE


@query
def op13_cover_quantize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_quantize.per_vector(table(spark, sf_dir, "embeddings"))


ORACLES["op13_cover_quantize"] = cover_quantize.ORACLE


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
