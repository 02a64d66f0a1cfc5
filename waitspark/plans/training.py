"""From the processed table to two trained models and their comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.operators.boosting import MAX_ROUNDS, PATIENCE, train_trees
from waitspark.operators.learning import (
    SPLIT_KEYS,
    Scaler,
    assemble,
    fit_scaler,
    model_frame,
    with_split,
)
from waitspark.operators.metrics import compare_models, with_residual
from waitspark.operators.network import EPOCHS, WaitNetwork, train_network
from waitspark.operators.sampling import sample
from waitspark.schema import FEATURES, TARGET
from waitspark.workspace import materialize

MODELS = ["network", "trees"]


@dataclass(frozen=True)
class Splits:
    train: DataFrame
    validation: DataFrame
    test: DataFrame
    scaler: Scaler


@dataclass(frozen=True)
class WaitModel:
    """A trained model with the scaling of its features: it scores rows of the processed table."""

    scaler: Scaler
    model: WaitNetwork | GBTRegressionModel

    def transform(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prediction``; a row that lacks a feature is left out.

        The features stay as they are, and the scaled ones take no name that ``rows`` has.
        """
        own = f"{'_' * (1 + max((len(c) for c in rows.columns), default=0))}row"
        held = rows.select(*FEATURES, F.struct(*rows.columns).alias(own))
        scored = self.model.transform(assemble(self.scaler.apply(held)))
        kept = [F.col(own)[c].alias(c) for c in rows.columns if c != "prediction"]
        return scored.select(*kept, "prediction")

    def save(self, path: str) -> None:
        self.scaler.save(f"{path}/scaler")
        if isinstance(self.model, WaitNetwork):
            self.model.save(f"{path}/network")
        else:
            self.model.write().overwrite().save(f"{path}/trees")

    @classmethod
    def load_network(cls, path: str) -> WaitModel:
        return cls(Scaler.load(f"{path}/scaler"), WaitNetwork.load(f"{path}/network"))

    @classmethod
    def load_trees(cls, path: str) -> WaitModel:
        return cls(Scaler.load(f"{path}/scaler"), GBTRegressionModel.load(f"{path}/trees"))


@dataclass(frozen=True)
class Comparison:
    trees: WaitModel
    network: WaitModel
    loss_curve: DataFrame
    predictions: DataFrame
    table: DataFrame


def scaled_splits(processed: DataFrame, fraction: float | None = None) -> Splits:
    """Standardised feature vectors of the three splits, each a part of one written table."""
    rows = with_split(model_frame(sample(processed, fraction), *_extra_keys()))
    rows = materialize(rows.select("split", *FEATURES, TARGET), "model", ["split"])
    scaler = fit_scaler(rows.filter(F.col("split") == "train"))
    scaled = assemble(scaler.apply(rows)).select("split", "features", TARGET)
    parts = [scaled.filter(F.col("split") == name) for name in ("train", "validation", "test")]
    return Splits(*parts, scaler)


def _extra_keys() -> list[str]:
    return [k for k in SPLIT_KEYS if k not in FEATURES]


def label_predictions(model, name: str, test: DataFrame) -> DataFrame:
    """(model, label, prediction, residual) of a fitted model on a split."""
    scored = model.transform(test)
    return with_residual(
        scored.select(F.lit(name).alias("model"), F.col(TARGET).alias("label"), "prediction")
    )


def train_and_compare(
    processed: DataFrame,
    fraction: float | None = None,
    max_rounds: int = MAX_ROUNDS,
    patience: int = PATIENCE,
    epochs: int = EPOCHS,
) -> Comparison:
    """Trains the network and the boosted trees and scores both on the test split."""
    splits = scaled_splits(processed, fraction)
    network, network_curve = train_network(splits.train, splits.validation, epochs)
    trees, trees_curve = train_trees(splits.train, splits.validation, max_rounds, patience)
    predictions = label_predictions(network, "network", splits.test).unionByName(
        label_predictions(trees, "trees", splits.test)
    )
    return Comparison(
        WaitModel(splits.scaler, trees),
        WaitModel(splits.scaler, network),
        network_curve.unionByName(trees_curve),
        predictions,
        compare_models(predictions, MODELS),
    )
