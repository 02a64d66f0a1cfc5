"""Residuals, regression metrics and the comparison of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.workspace import materialize

# Names and order of the metrics, and their text format.
METRICS = {"MSE": "mse", "RMSE": "rmse", "MAE": "mae", "R²": "r2"}
METRIC_FORMAT = "%.4f"


def residual(prediction: str = "prediction", label: str = "label") -> Column:
    return F.col(prediction) - F.col(label)


def with_residual(predictions: DataFrame) -> DataFrame:
    return predictions.withColumn("residual", residual())


def regression_metrics(predictions: DataFrame, *groups: str) -> DataFrame:
    """MSE, RMSE, MAE and R² of (prediction, label), per group, in one aggregate.

    R² is null where the label does not vary.
    """
    error = residual()
    sums = predictions.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop("label").alias("variance"),
    )
    unexplained = F.try_divide("mse", "variance")
    return sums.select(
        *groups,
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        (F.lit(1.0) - unexplained).alias("r2"),
    )


def compare_models(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per metric, one text column per model, from (model, label, prediction)."""
    metrics = regression_metrics(predictions, "model")
    pairs = [
        F.struct(F.lit(i).alias("place"), F.lit(m).alias("metric"), F.col(c).alias("value"))
        for i, (m, c) in enumerate(METRICS.items())
    ]
    values = metrics.select("model", F.inline(F.array(*pairs)))
    text = F.format_string(METRIC_FORMAT, F.first("value"))
    wide = values.groupBy("place", "metric").pivot("model", list(models)).agg(text)
    return wide.orderBy("place").drop("place")


def predict_by_mean(
    train: DataFrame, test: DataFrame, key: str, label: str
) -> DataFrame:
    """``test`` with the training mean of its key as prediction; unseen keys get the mean of all."""
    overall = train.agg(F.avg(label)).first()[0]
    means = train.groupBy(key).agg(F.avg(label).alias("prediction"))
    joined = test.join(materialize(means, "means"), key, "left")
    return joined.withColumns(
        {
            "prediction": F.coalesce("prediction", F.lit(overall).cast("double")),
            "label": F.col(label),
        }
    )
