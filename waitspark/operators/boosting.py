"""Boosted regression trees in one training run that ends by the patience rule.

A round fits one tree of Spark ML to what the earlier ones leave over. Each tree gets its own share of
the rows, by a hash, and of the features: the others are constant in its training rows, so it cannot
split on them, yet its feature numbers are those of the whole vector and all trees form one
ensemble.

A tree and a prediction see nothing of a row but its features, and the features follow from the hour and
the zone. So rounds work on one point for each distinct feature vector: the learner weighs a point by
the number of its rows drawn and fits it to their mean rest, which gives the splits and leaves of the rows
themselves, and losses add up from a point's count, mean and spread of labels. Points grow with hours times
zones, not with rows; every ``WRITE_EVERY`` rounds one pass over all rows draws the shares of the rounds to
come. The running prediction is a column of the written points; between two writes it is that column
plus the few trees since, so plans stay short and a lost executor costs its own tasks only.

Labels are summed as multiples of ``GRID`` and what is left over is rounded to it. Sums of such numbers and
of their squares are exact as long as they fit into 53 bits, so partitioning and core count do not change a tree.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    GBTRegressionModel,
    GBTRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.losses import loss_rows, round_to_keep
from waitspark.schema import SEED, TARGET
from waitspark.workspace import discard, materialize

# Settings of the boosting.
TREE_DEPTH = 6
LEARNING_RATE = 0.1
ROW_SHARE = 0.8
FEATURE_SHARE = 0.8
MAX_ROUNDS = 1000
PATIENCE = 50

# More bins than the widest feature, the pickup zone, has values.
TREE_BINS = 512
# Trees between two writes of the running prediction.
WRITE_EVERY = 10
# Unit of what a tree is fitted to: a tenth of a hundredth of a minute or so.
GRID = 2.0**-10
POINT_COLUMNS = ["split", "x", "n", "mean", "spread", "prediction"]


def row_share(round_number: int, share: float = ROW_SHARE) -> Column:
    """Whether a row takes part in a round; equal rows do so together."""
    bucket = F.pmod(F.xxhash64("x", "label", F.lit(f"{SEED}-{round_number}")), F.lit(1_000_000))
    return bucket < F.lit(round(share * 1_000_000))


def feature_share(round_number: int, size: int, share: float = FEATURE_SHARE) -> list[int]:
    """The features that a round's tree may split on."""
    draw = random.Random(f"{SEED}-{round_number}")
    return sorted(draw.sample(range(size), max(1, int(share * size))))


def _masked(size: int, chosen: list[int]) -> Column:
    parts = [F.col("x")[i] if i in chosen else F.lit(0.0) for i in range(size)]
    return array_to_vector(F.array(*parts))


def points(rows: DataFrame) -> DataFrame:
    """(split, x, n, mean, spread, prediction) of each split's distinct feature vectors.

    ``spread`` is the sum of squared differences of the labels from their mean.
    """
    n = F.count(F.lit(1))
    found = rows.groupBy("split", "x").agg(n.alias("n"), F.avg("label").alias("mean"), (F.var_pop("label") * n).alias("spread"))
    return found.withColumn("prediction", F.lit(0.0))


def with_shares(state: DataFrame, rows: DataFrame, rounds: Sequence[int]) -> DataFrame:
    """``state`` with the count and the sum of labels, in units of ``GRID``, of a point's rows in each of some rounds."""
    units = F.rint(F.col("label") / F.lit(GRID))
    sums = []
    for i in rounds:
        sums += [F.count_if(row_share(i)).alias(f"_n{i}"), F.sum(F.when(row_share(i), units)).alias(f"_sum{i}")]
    shares = rows.filter("split = 'train'").groupBy("split", "x").agg(*sums)
    return state.join(shares, ["split", "x"], "left")


def _losses(state: DataFrame, split: str, predictions: list[str]) -> list[float | None]:
    """Mean squared errors of a split's rows, for each of some columns, in one pass."""
    errors = [F.col("spread") + F.col("n") * (F.col("mean") - F.col(p)) ** 2 for p in predictions]
    return list(state.filter(F.col("split") == split).agg(*[F.sum(e) / F.sum("n") for e in errors]).first())


def train_trees(
    train: DataFrame,
    validation: DataFrame,
    max_rounds: int = MAX_ROUNDS,
    patience: int = PATIENCE,
    label: str = TARGET,
) -> tuple[GBTRegressionModel, DataFrame]:
    """(boosted trees up to the round of least validation loss, loss per round of both splits).

    Training ends ``patience`` rounds after the least validation loss. The first tree counts whole,
    as in Spark's own boosting, the others by the learning rate. Without validation rows the loss
    of the training rows decides.
    """
    spark = train.sparkSession
    parts = [
        rows.select(
            F.lit(name).alias("split"),
            vector_to_array("features").alias("x"),
            F.col(label).cast("double").alias("label"),
        )
        for name, rows in (("train", train), ("validation", validation))
    ]
    rows = materialize(parts[0].unionByName(parts[1]), "boosting", ["split"])
    first = rows.filter("split = 'train'").select(F.size("x")).first()
    if first is None:
        raise ValueError("no training rows")
    validated = not rows.filter("split = 'validation'").isEmpty()

    def drawn(state: DataFrame, number: int) -> DataFrame:
        """``state`` with the shares of the rounds after ``number`` up to the next write."""
        end = min(number + (WRITE_EVERY if validated else 1), max_rounds)
        return materialize(with_shares(state, rows, range(number + 1, end + 1)), "boosting", ["split"])

    base = materialize(points(rows), "points", ["split"])
    state = drawn(base, 0)
    discard(base)
    trees: list[DecisionTreeRegressionModel] = []
    losses: dict[str, list[float]] = {"train": [], "validation": []}
    deciding = losses["validation" if validated else "train"]
    keep, settled = 0, False
    current, steps = state.withColumn("features", array_to_vector("x")), ["prediction"]
    while not settled and len(trees) < max_rounds:
        number = len(trees) + 1
        share = current.filter("split = 'train'").filter(F.col(f"_n{number}") > 0)
        mean = F.col(f"_sum{number}") / F.col(f"_n{number}")
        rest = F.rint(mean - F.col(steps[-1]) / F.lit(GRID)) * F.lit(GRID)
        chosen = feature_share(number, first[0])
        fitted = share.select(
            _masked(first[0], chosen).alias("features"), rest.alias("rest"), F.col(f"_n{number}").cast("double").alias("rows")
        )
        # The learner reads its points a few times; a part that is lost is made again.
        fitted = fitted.persist(StorageLevel.MEMORY_AND_DISK)
        trees.append(_learner().fit(fitted))
        fitted.unpersist()
        tree, weight = trees[-1], 1.0 if number == 1 else LEARNING_RATE
        current = tree.setFeaturesCol("features").setPredictionCol("_tree").transform(current)
        added = F.col(steps[-1]) + F.col("_tree") * F.lit(weight)
        steps.append(f"_after{number}")
        current = current.withColumn(steps[-1], added).drop("_tree")
        if validated:
            losses["validation"] += _losses(current, "validation", steps[-1:])
        full = len(steps) > WRITE_EVERY or number == max_rounds or not validated
        keep, settled = round_to_keep(deciding, patience) if validated else (0, False)
        if full or settled:
            losses["train"] += _losses(current, "train", steps[1:])
            keep, settled = round_to_keep(deciding, patience)
            if not settled and number < max_rounds:
                held = [c for c in POINT_COLUMNS if c != "prediction"]
                written = drawn(current.select(*held, F.col(steps[-1]).alias("prediction")), number)
                discard(state)
                state = written
                current, steps = state.withColumn("features", array_to_vector("x")), ["prediction"]
    discard(state, rows)
    curves = [loss_rows(spark, "trees", name, found) for name, found in losses.items()]
    return ensemble(trees[:keep]), curves[0].unionByName(curves[1])


def _learner() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(
        labelCol="rest", weightCol="rows", maxDepth=TREE_DEPTH, maxBins=TREE_BINS, seed=SEED, maxMemoryInMB=512
    )


def ensemble(trees: list[DecisionTreeRegressionModel]) -> GBTRegressionModel:
    """The trees as one model, which predicts in one pass and is saved as one."""
    gateway = SparkSession.active().sparkContext._gateway
    package = gateway.jvm.org.apache.spark.ml.regression
    members = gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        members[i], weights[i] = tree._java_obj, 1.0 if i == 0 else LEARNING_RATE
    settings = GBTRegressor(maxIter=len(trees), maxDepth=TREE_DEPTH, maxBins=TREE_BINS, stepSize=LEARNING_RATE, seed=SEED)
    model = GBTRegressionModel(package.GBTRegressionModel(settings.uid, members, weights))
    return settings._copyValues(model)
