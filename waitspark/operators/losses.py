"""Loss curves of trained models, and the rule that ends a training."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def round_to_keep(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds up to the least loss, whether ``patience`` rounds brought none lower)."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def loss_rows(spark: SparkSession, model: str, split: str, losses) -> DataFrame:
    rows = [(model, i + 1, split, float(loss)) for i, loss in enumerate(losses)]
    return spark.createDataFrame(
        rows, "model string, iteration int, split string, loss double"
    )
