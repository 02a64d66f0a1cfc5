"""Queries of the operators on training text, and their SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waitspark.llm import (
    byte_bpe,
    context_mixing,
    embedding_whitening,
    exact_dedup,
    html_text,
    jaccard_join,
    merkle_manifest,
    mixing,
    quality_classifier,
    quality_rules,
    sentencepiece_codec,
    token_files,
    toxicity,
)
from waitspark.llm.common import read


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.op1(read(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.op3(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.op4(read(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(read(spark, sf_dir, "pages"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_mixing.score(read(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.op7(read(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.op8(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(read(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.op10(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.op11(read(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.op12(read(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.op13(read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_quality_classifier,
        op3_mixing,
        op4_exact_dedup,
        op5_html_text,
        op6_context_mixing,
        op7_jaccard_join,
        op8_toxicity,
        op9_quality_rules,
        op10_token_files,
        op11_merkle_manifest,
        op12_embedding_whitening,
        op13_byte_bpe,
    )
}
ORACLE = {
    "op3_mixing": mixing.SQL,
    "op4_exact_dedup": exact_dedup.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op11_merkle_manifest": merkle_manifest.SQL,
}
