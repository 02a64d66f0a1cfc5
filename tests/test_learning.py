"""Splits, scaling and models on a planted signal."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import functions as F

from waitspark.operators import network as net
from waitspark.operators.boosting import feature_share, row_share, train_trees
from waitspark.operators.learning import (
    assemble,
    fit_scaler,
    model_frame,
    with_split,
)
from waitspark.operators.losses import round_to_keep
from waitspark.operators.metrics import regression_metrics
from waitspark.operators.network import Shape, WaitNetwork, train_network
from waitspark.operators.ordering import with_positions
from waitspark.plans.training import WaitModel, label_predictions, train_and_compare
from waitspark.schema import FEATURES, TARGET


@pytest.fixture(scope="module")
def planted(spark):
    """Waits that depend on the hour, the weekend and the weather, with little noise."""
    rng = np.random.default_rng(11)
    n = 3000
    frame = pd.DataFrame({f: rng.integers(0, 20, n) for f in FEATURES})
    frame["request_hour"] = rng.integers(0, 24, n)
    frame["is_weekend"] = rng.integers(0, 2, n)
    signal = np.abs(frame["request_hour"] - 12) + 4 * frame["is_weekend"]
    frame[TARGET] = (signal + 5 + rng.normal(0, 0.3, n)).round(1)
    frame["DOLocationID"] = rng.integers(0, 20, n)
    start = pd.Timestamp("2024-01-01")
    frame["request_datetime"] = start + pd.to_timedelta(rng.integers(0, 10**7, n), unit="s")
    frame["on_scene_datetime"] = frame["request_datetime"] + pd.Timedelta(minutes=5)
    return spark.createDataFrame(frame).cache()


@pytest.fixture(scope="module")
def parts(planted):
    rows = with_split(planted)
    train = rows.filter(F.col("split") == "train")
    scaled = assemble(fit_scaler(train).apply(rows)).cache()
    return {s: scaled.filter(F.col("split") == s) for s in ("train", "validation", "test")}


def test_splits_are_whole_and_fixed(planted):
    counts = {r["split"]: r["count"] for r in with_split(planted).groupBy("split").count().collect()}
    assert sum(counts.values()) == 3000
    assert counts["train"] == pytest.approx(1800, abs=120)
    assert counts["test"] == pytest.approx(600, abs=90)
    keys = ["request_datetime", "PULocationID", "split"]
    found = {
        tuple(sorted(map(str, with_split(planted.repartition(n)).select(keys).collect())))
        for n in (1, 4, 7)
    }
    assert len(found) == 1


def test_copies_stay_in_one_split(planted):
    twice = planted.unionByName(planted)
    keys = ["request_datetime", "on_scene_datetime", "PULocationID", "DOLocationID"]
    spread = with_split(twice).groupBy(*keys).agg(F.countDistinct("split").alias("n"))
    assert spread.agg(F.max("n")).first()[0] == 1


def test_model_frame(spark, planted):
    negative = planted.withColumn(TARGET, F.when(F.col("is_weekend") == 1, -1.0))
    assert model_frame(planted).columns == [*FEATURES, TARGET]
    assert model_frame(negative).count() == 0


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0), (8.0, 4.0)], "a double, b double")
    got = fit_scaler(df, ["a", "b"]).apply(df).toPandas()
    a = np.array([1.0, 3.0, 8.0])
    assert sorted(got["a"]) == pytest.approx(sorted((a - a.mean()) / a.std()))
    assert list(got["b"]) == [0.0, 0.0, 0.0]


def test_patience():
    assert round_to_keep([5, 4, 3, 3.5, 3.4, 3.3, 1], 3) == (3, True)
    assert round_to_keep([5, 4, 3, 3.5, 2], 3) == (5, False)
    assert round_to_keep([5, 6, 7, 8], 10) == (1, False)


def beats_the_mean(predictions) -> bool:
    row = regression_metrics(predictions).first()
    return row["r2"] > 0.5


def test_trees(parts, tmp_path):
    model, curve = train_trees(parts["train"], parts["validation"], max_rounds=25, patience=5)
    assert beats_the_mean(label_predictions(model, "trees", parts["test"]))
    losses = curve.filter("split = 'validation'").orderBy("iteration").toPandas()["loss"]
    assert model.getNumTrees == int(losses.idxmin()) + 1 or model.getNumTrees == len(losses)
    path = str(tmp_path / "trees")
    model.write().save(path)
    again = GBTRegressionModel.load(path)
    before = model.transform(parts["test"]).select("prediction").toPandas()
    after = again.transform(parts["test"]).select("prediction").toPandas()
    assert before.equals(after)


def test_trees_stop_where_there_is_nothing_to_learn(parts):
    noise = {
        s: parts[s].withColumn(TARGET, F.rand(seed) * 10)
        for seed, s in enumerate(("train", "validation"))
    }
    noise = {s: df.cache() for s, df in noise.items()}
    model, curve = train_trees(noise["train"], noise["validation"], max_rounds=64, patience=2)
    assert model.getNumTrees < 64
    assert curve.filter("split = 'validation'").count() < 64


def test_a_shorter_run_is_the_start_of_a_longer_one(parts):
    _, short = train_trees(parts["train"], parts["validation"], max_rounds=2)
    _, long = train_trees(parts["train"], parts["validation"], max_rounds=4)
    both = [
        [r["loss"] for r in c.filter("split = 'train'").orderBy("iteration").collect()]
        for c in (short, long)
    ]
    assert both[0] == pytest.approx(both[1][:2])


def test_network(parts, tmp_path):
    network, curve = train_network(parts["train"], epochs=60)
    predictions = label_predictions(network, "network", parts["test"])
    assert beats_the_mean(predictions)
    assert curve.count() > 1
    network.save(str(tmp_path / "network"))
    again = WaitNetwork.load(str(tmp_path / "network"))
    before = predictions.select("prediction").toPandas()
    after = label_predictions(again, "network", parts["test"]).select("prediction").toPandas()
    assert before.equals(after)


def test_train_and_compare(planted):
    found = train_and_compare(planted, max_rounds=4, patience=2, epochs=10)
    assert [r["metric"] for r in found.table.collect()] == ["MSE", "RMSE", "MAE", "R²"]
    assert found.table.columns == ["metric", "network", "trees"]
    models = {r["model"] for r in found.loss_curve.select("model").distinct().collect()}
    assert models == {"network", "trees"}


def test_exactly_the_rounds_of_the_rule_are_trained(parts, monkeypatch):
    trained = []
    fit = DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, df: trained.append(1) or fit(self, df))
    noise = {
        s: parts[s].withColumn(TARGET, F.col(TARGET) + F.pmod(F.xxhash64("features"), F.lit(40))).cache()
        for s in ("train", "validation")
    }
    model, curve = train_trees(noise["train"], noise["validation"], max_rounds=60, patience=3)
    losses = [r["loss"] for r in curve.filter("split = 'validation'").orderBy("iteration").collect()]
    best = losses.index(min(losses)) + 1
    assert model.getNumTrees == best and len(losses) == len(trained) == min(best + 3, 60)
    scored = model.transform(noise["validation"])
    assert scored.agg(F.avg((F.col("prediction") - F.col(TARGET)) ** 2)).first()[0] == pytest.approx(min(losses))


def test_the_learner_sees_a_point_for_each_feature_vector(spark, monkeypatch):
    """Rows of equal features cost the learner one row, and its tree is that of all rows."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"a": rng.integers(0, 12, 4000).astype(float), "b": rng.integers(0, 3, 4000).astype(float)})
    frame[TARGET] = (frame["a"] * 2 - 3 * frame["b"] + rng.normal(0, 2, 4000)).round(1)
    rows = assemble(spark.createDataFrame(frame), ["a", "b"]).cache()
    seen = []
    fit = DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    model, curve = train_trees(rows, rows, max_rounds=1)
    assert seen == [36]
    drawn = rows.select(vector_to_array("features").alias("x"), F.col(TARGET).alias("label")).filter(row_share(1))
    chosen = feature_share(1, 2)
    masked = F.array(*[F.col("x")[i] if i in chosen else F.lit(0.0) for i in range(2)])
    whole = fit(DecisionTreeRegressor(labelCol="label", maxDepth=6, maxBins=512), drawn.select(array_to_vector(masked).alias("features"), "label"))
    one, other = (m.transform(rows).select("prediction").toPandas()["prediction"] for m in (model, whole))
    assert list(one) == pytest.approx(list(other), abs=1e-3) and one.nunique() > 2
    errors = (one - rows.select(TARGET).toPandas()[TARGET]) ** 2
    assert [r["loss"] for r in curve.collect()] == pytest.approx([errors.mean()] * 2)


def test_trees_do_not_depend_on_partitioning(parts):
    found = []
    for n in (1, 5):
        model, _ = train_trees(parts["train"].repartition(n), parts["validation"].repartition(n), max_rounds=12)
        found.append(model.toDebugString.split("\n", 1)[1])
    assert found[0] == found[1]


def test_each_tree_has_its_own_rows_and_features(parts):
    drawn = [tuple(feature_share(i, 9)) for i in range(1, 30)]
    assert {len(f) for f in drawn} == {7} and len(set(drawn)) > 10
    from pyspark.ml.functions import vector_to_array

    rows = parts["train"].select(vector_to_array("features").alias("x"), F.col(TARGET).alias("label"))
    shares = rows.agg(*[F.avg(row_share(i).cast("int")) for i in (1, 2)], F.avg((row_share(1) & row_share(2)).cast("int"))).first()
    assert shares[0] == pytest.approx(0.8, abs=0.04) and shares[1] == pytest.approx(0.8, abs=0.04)
    assert shares[2] == pytest.approx(0.64, abs=0.05)
    model, _ = train_trees(parts["train"], parts["validation"], max_rounds=6)
    for i, text in enumerate(model.toDebugString.split("Tree ")[1:]):
        import re

        assert set(map(int, re.findall(r"feature (\d+)", text))) <= set(feature_share(i + 1, 9))


def test_gradient_equals_differences():
    shape = Shape((3, 5, 4, 2, 1))
    rng = np.random.default_rng(5)
    theta = shape.start(1) + rng.normal(0, 0.1, shape.length)
    x, y = rng.normal(size=(20, 3)), rng.normal(size=20)
    _, slope, _ = net.gradient(shape, theta, x, y, None)
    for i in range(0, shape.length, 3):
        step = np.zeros(shape.length)
        step[i] = 1e-6
        up, down = (net.gradient(shape, theta + s, x, y, None)[0] for s in (step, -step))
        assert slope[i] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-5)


def one_process(rows, epochs, size):
    """The training in plain NumPy on the same blocks: (batch, block, data)."""
    shape = Shape((size, *net.HIDDEN_LAYERS, 1))
    theta = shape.start(net.SEED)
    first = second = np.zeros_like(theta)
    step = 0
    for epoch in range(epochs):
        steps = 1 + max(b for b, _, _ in rows)
        for k in np.random.default_rng((net.SEED, epoch)).permutation(steps):
            total, n = np.zeros_like(theta), 0
            for batch, block, data in rows:
                if batch == k:
                    rng = np.random.default_rng((net.SEED, epoch, block))
                    total = total + net.gradient(shape, theta, data[:, :-1], data[:, -1], rng)[1]
                    n += len(data)
            step += 1
            first = 0.9 * first + 0.1 * total / n
            second = 0.999 * second + 0.001 * (total / n) ** 2
            theta = theta - net.STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta


def test_network_steps_equal_one_process(parts):
    trained, _ = train_network(parts["train"], epochs=3)
    table, steps, total = net.blocks(parts["train"], TARGET, 9, trained.mean, trained.spread, net.STEPS)
    rows = [(r["batch"], r["block"], np.frombuffer(r["data"]).reshape(-1, 10)) for r in table.collect()]
    assert sum(len(d) for _, _, d in rows) == total == parts["train"].count() and steps == len(rows) == 4
    wanted = one_process(sorted(rows, key=lambda r: r[1]), 3, 9)
    assert trained.theta == pytest.approx(wanted, abs=1e-6)


def test_network_does_not_depend_on_partitioning(parts):
    found = [train_network(parts["train"].repartition(n), epochs=2)[0].theta for n in (1, 6)]
    assert np.array_equal(*found)


def test_network_goes_on_from_an_epoch(parts, tmp_path):
    folder = f"file://{tmp_path}/state"
    whole, curve = train_network(parts["train"], parts["validation"], epochs=4)
    train_network(parts["train"], parts["validation"], epochs=2, state=folder)
    resumed, again = train_network(parts["train"], parts["validation"], epochs=4, state=folder)
    assert np.array_equal(whole.theta, resumed.theta)
    assert curve.orderBy("split", "iteration").collect() == again.orderBy("split", "iteration").collect()
    earlier, _ = train_network(parts["train"], parts["validation"], epochs=4, state=folder, restart=1)
    assert np.array_equal(whole.theta, earlier.theta)
    assert {r["split"] for r in curve.collect()} == {"train", "validation"}


def test_blocks_share_out_copies(spark):
    rows = assemble(spark.createDataFrame([(1.0, 2.0)] * 1500 + [(float(i), 3.0) for i in range(100)], "a double, b double"), ["a"])
    table, steps, total = net.blocks(rows, "b", 1, 0.0, 1.0, 8)
    sizes = [len(r["data"]) // 16 for r in table.collect()]
    assert total == 1600 and sum(sizes) == 1600 and max(sizes) - min(sizes) <= 1 and steps == 4


def test_positions_are_a_total_order(spark):
    rows = spark.createDataFrame([(i % 7, i % 3) for i in range(200)] + [(0, 0)] * 300, "a int, b int").repartition(5)
    got = with_positions(rows, ["a", "b"]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(500))
    assert [(r["a"], r["b"]) for r in got] == sorted((r["a"], r["b"]) for r in got)
    assert with_positions(rows.filter("a > 100"), ["a"]).count() == 0


def test_a_loaded_model_scores_raw_rows(planted, parts, tmp_path):
    scaler = fit_scaler(with_split(planted).filter("split = 'train'"))
    model, _ = train_trees(parts["train"], parts["validation"], max_rounds=3)
    network, _ = train_network(parts["train"], epochs=2)
    for name, fitted, load in (("t", model, WaitModel.load_trees), ("n", network, WaitModel.load_network)):
        bundle = WaitModel(scaler, fitted)
        bundle.save(str(tmp_path / name))
        rows = planted.withColumn("features", F.lit("mine")).withColumn("_row", F.lit(1))
        before, after = (m.transform(rows) for m in (bundle, load(str(tmp_path / name))))
        assert before.columns == [*rows.columns, "prediction"]
        assert {r["features"] for r in after.collect()} == {"mine"}
        one, two = (df.orderBy(*SORT).select("prediction").toPandas() for df in (before, after))
        assert one.equals(two) and len(one) == 3000


SORT = ["request_datetime", "PULocationID", "DOLocationID", TARGET]
