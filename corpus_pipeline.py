"""A training-corpus pipeline: toxicity, exact dedup, near dedup, mixing, token ids.

Each stage takes all rows its predecessor kept, and what it decides takes effect in its result, which is
written as Parquet and read again as the next stage's documents. All stages but the last return the
columns of documents; the last adds the token ids. Rows with null or empty text pass the toxicity and near
dedup stages (exact dedup keeps one of them); an empty table passes all stages empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.llm import exact_dedup, jaccard_join, mixing, sentencepiece_codec, toxicity
from waitspark.llm.common import read, share_package
from waitspark.workspace import materialize

#: A document is rejected if toxic at least this likely.
TOXIC = 0.5
#: Near copies share at least NEAR_PERCENT of their NEAR_SHINGLE-word shingles.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below TOXIC; the model learns from the labels of ``sf_dir``."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, tuple(docs.columns), "_score")
    return scored.filter(F.col("_score") < TOXIC).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    share_package(spark)
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    share_package(spark)
    return jaccard_join.one_of_each(docs, NEAR_SHINGLE, NEAR_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ids, n_tokens and score of their SentencePiece encoding."""
    share_package(spark)
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", to_tokens),
]

#: SQL can state neither the trained model nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
