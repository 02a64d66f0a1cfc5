"""Splits, features and scaling of the models' input; the models are in boosting and network."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.functions.hashing import hash_unit
from waitspark.operators.cleaning import keep_non_negative
from waitspark.schema import FEATURES, TARGET

# Split shares and keys.
TRAIN_SHARE = 0.6
VALIDATION_SHARE = 0.2
SPLIT_KEYS = ["request_datetime", "on_scene_datetime", "PULocationID", "DOLocationID"]


def with_split(df: DataFrame, keys: Sequence[str] = SPLIT_KEYS) -> DataFrame:
    """Adds ``split``: 60 % train, 20 % validation, 20 % test by a hash of the keys.

    The assignment is the same under any partitioning, and copies of a row stay together.
    """
    bucket = F.floor(hash_unit(keys) * F.lit(100.0))
    name = (
        F.when(bucket < round(TRAIN_SHARE * 100), "train")
        .when(bucket < round((TRAIN_SHARE + VALIDATION_SHARE) * 100), "validation")
        .otherwise("test")
    )
    return df.withColumn("split", name)


def model_frame(processed: DataFrame, *extra: str) -> DataFrame:
    """The features and a non-negative wait."""
    return keep_non_negative(processed.select(*extra, *FEATURES, TARGET), TARGET)


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per column; a constant column is only centred."""

    columns: list[str]
    means: list[float]
    deviations: list[float]

    def save(self, path: str) -> None:
        rows = list(zip(range(len(self.columns)), self.columns, self.means, self.deviations))
        SparkSession.active().createDataFrame(
            rows, "place int, name string, mean double, deviation double"
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> Scaler:
        rows = SparkSession.active().read.parquet(path).orderBy("place").collect()
        return cls(*(list(c) for c in zip(*[(r["name"], r["mean"], r["deviation"]) for r in rows])))

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(c) - F.lit(m)) / F.lit(s)
                for c, m, s in zip(self.columns, self.means, self.deviations)
            }
        )


def fit_scaler(train: DataFrame, columns: Sequence[str] = FEATURES) -> Scaler:
    """One aggregate over the training rows; only they set the scale."""
    row = train.agg(
        *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]
    ).first()
    n = len(columns)
    means = [m if m is not None else 0.0 for m in row[:n]]
    return Scaler(list(columns), means, [s or 1.0 for s in row[n:]])


def assemble(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=list(columns), outputCol="features", handleInvalid="skip"
    )
    return assembler.transform(df)
