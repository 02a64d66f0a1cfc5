"""Queries over model input, the two trained models, and the whole pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.boosting import MAX_ROUNDS, PATIENCE, train_trees
from waitspark.operators.learning import fit_scaler, model_frame, with_split
from waitspark.operators.losses import round_to_keep
from waitspark.operators.metrics import regression_metrics
from waitspark.operators.network import EPOCHS, train_network
from waitspark.plans.training import WaitModel, label_predictions, train_and_compare
from waitspark.registry import common as c
from waitspark.schema import FEATURES, TARGET
from waitspark.workspace import scratch_path

# Budgets and the share of the variance to explain where the wait follows from the features.
SIGNAL_ROUNDS, SIGNAL_EPOCHS, EXPLAINED = 30, 30, 0.7


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_frame(c.processed(spark, sf_dir))


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_split(c.processed(spark, sf_dir))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_split(c.processed(spark, sf_dir))
    scaler = fit_scaler(rows.filter(F.col("split") == "train"))
    scaled = scaler.apply(rows)
    return scaled.select("split", "request_datetime", *[c.rounded(f) for f in FEATURES])


def trees(spark: SparkSession, sf_dir: str):
    """The fitted trees and their loss curve, trained once per input."""

    def make():
        parts = c.splits(spark, sf_dir)
        return train_trees(parts.train, parts.validation)

    return c.stored(spark, sf_dir, "trees", make)


def network(spark: SparkSession, sf_dir: str):
    """The trained network and its loss curve, trained once per input."""

    def make():
        parts = c.splits(spark, sf_dir)
        return train_network(parts.train, parts.validation)

    return c.stored(spark, sf_dir, "network", make)


def tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = trees(spark, sf_dir)
    return label_predictions(model, "trees", c.splits(spark, sf_dir).test)


def network_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = network(spark, sf_dir)
    return label_predictions(model, "network", c.splits(spark, sf_dir).test)


def loss_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees(spark, sf_dir)[1].unionByName(network(spark, sf_dir)[1])


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model, test rows whose prediction changes by saving and loading: none.

    A saved model holds its scaling, so the loaded one scores rows of the processed table as they are.
    """
    rows = with_split(c.processed(spark, sf_dir)).filter((F.col("split") == "test") & (F.col(TARGET) >= 0))
    scaler = c.splits(spark, sf_dir).scaler
    path = scratch_path(spark, "models")
    parts = []
    for name, fitted, load in (
        ("trees", trees(spark, sf_dir)[0], WaitModel.load_trees),
        ("network", network(spark, sf_dir)[0], WaitModel.load_network),
    ):
        before = WaitModel(scaler, fitted)
        before.save(f"{path}/{name}")
        once = before.transform(rows).withColumnRenamed("prediction", "before")
        twice = load(f"{path}/{name}").transform(once)
        changed = F.count_if(F.col("before") != F.col("prediction")).alias("changed")
        parts.append(twice.agg(F.count(F.lit(1)).alias("n"), changed).select(F.lit(name).alias("model"), "n", "changed"))
    return parts[0].unionByName(parts[1])


def training_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of any training: both losses of every round, an end by the rule, a score for each test row."""
    rows = []
    for name, (model, curve) in (("trees", trees(spark, sf_dir)), ("network", network(spark, sf_dir))):
        found = {"train": [], "validation": []}
        for r in curve.orderBy("iteration").collect():
            found[r["split"]].append(r["loss"])
        train, validation = found["train"], found["validation"]
        if name == "trees":
            best, _ = round_to_keep(validation, PATIENCE)
            ended = len(validation) == min(best + PATIENCE, MAX_ROUNDS) and model.getNumTrees == best
        else:
            ended = len(validation) == EPOCHS
        scored = label_predictions(model, name, c.splits(spark, sf_dir).test)
        n = scored.filter(F.col("prediction").isNotNull() & ~F.isnan("prediction")).count()
        rows.append((name, n, len(train) == len(validation), ended, train[-1] < train[0]))
    schema = "model string, test_rows long, curves_complete boolean, ended_by_rule boolean, training_loss_fell boolean"
    return spark.createDataFrame(rows, schema)


def models_on_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both models on waits that hour, weekend and zone decide: whether each explains most of them."""
    found = train_and_compare(c.signal(spark, sf_dir), max_rounds=SIGNAL_ROUNDS, patience=5, epochs=SIGNAL_EPOCHS)
    metrics = regression_metrics(found.predictions, "model")
    return metrics.select("model", "n", (F.col("r2") > EXPLAINED).alias("explains"))


def trained_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_and_compare(c.processed(spark, sf_dir)).table


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline from trips to the processed rows."""
    return c.build(spark, sf_dir).data


_scaled = ", ".join(
    f"""round(({f} - avg({f}) FILTER (WHERE split = 'train') OVER ())
  / coalesce(nullif(stddev_pop({f}) FILTER (WHERE split = 'train') OVER (), 0), 1), 6) AS {f}"""
    for f in FEATURES
)

QUERIES = {
    "model_frame": features,
    "split_counts": split_counts,
    "standardize": standardized,
    "gbt_predict": tree_predictions,
    "mlp_predict": network_predictions,
    "loss_curve": loss_curve,
    "model_roundtrip": model_roundtrip,
    "training_invariants": training_invariants,
    "models_on_signal": models_on_signal,
    "train_and_compare": trained_comparison,
    "processed": processed,
}

ORACLE = {
    "model_frame": c.with_(
        c.PROCESSED,
        f"SELECT {', '.join(FEATURES)}, wait_minutes FROM processed WHERE wait_minutes >= 0",
    ),
    "split_counts": c.with_(
        c.SPLIT, "SELECT split, count(*) AS n FROM split_rows GROUP BY split"
    ),
    "standardize": c.with_(
        c.SPLIT, f"SELECT split, request_datetime, {_scaled} FROM split_rows"
    ),
    "processed": c.with_(c.PROCESSED, "SELECT * FROM processed"),
    "model_roundtrip": c.with_(
        c.SPLIT,
        """SELECT model, (SELECT count(*) FROM split_rows
                WHERE split = 'test' AND wait_minutes >= 0) AS n, CAST(0 AS BIGINT) AS changed
FROM (VALUES ('trees'), ('network')) m(model)""",
    ),
    "training_invariants": c.with_(
        c.SPLIT,
        """SELECT model, (SELECT count(*) FROM split_rows
                WHERE split = 'test' AND wait_minutes >= 0) AS test_rows,
       true AS curves_complete, true AS ended_by_rule, true AS training_loss_fell
FROM (VALUES ('trees'), ('network')) m(model)""",
    ),
    "models_on_signal": c.with_(
        c.SPLIT,
        """SELECT model, (SELECT count(*) FROM split_rows WHERE split = 'test') AS n, true AS explains
FROM (VALUES ('trees'), ('network')) m(model)""",
    ),
}
