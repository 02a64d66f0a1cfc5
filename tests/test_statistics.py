"""Aggregates, distributions and metrics against NumPy and pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from waitspark.operators.aggregates import (
    describe,
    hourly_series,
    mean_wait_by_hour,
    mean_wait_by_zone,
    top_zones,
)
from waitspark.operators.distributions import correlation_matrix, density_curve, histogram
from waitspark.operators.metrics import (
    compare_models,
    predict_by_mean,
    regression_metrics,
    with_residual,
)


def frequencies(df, columns=("v",), bins=30):
    rows = histogram(df, list(columns), bins).orderBy("feature", "bin").collect()
    return [r["frequency"] for r in rows], [r["lower_edge"] for r in rows]


@pytest.mark.parametrize(
    "values",
    [
        np.arange(100) % 100,
        np.random.default_rng(1).normal(size=5000),
        np.full(7, 4),
        np.array([0, 33, 66, 99, 3, 6, 9]),
        np.arange(0, 3, 0.1),
    ],
    ids=["integers", "normal", "equal", "edges", "tenths"],
)
def test_histogram_equals_numpy(spark, values):
    counts, edges = np.histogram(values, bins=30)
    got, lower = frequencies(spark.createDataFrame(pd.DataFrame({"v": values})))
    assert got == list(counts)
    assert lower == pytest.approx(edges[:-1])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-1000, 1000), min_size=1, max_size=60), st.integers(1, 40))
def test_histogram_counts_every_row(spark, values, bins):
    got, _ = frequencies(spark.createDataFrame(pd.DataFrame({"v": values})), bins=bins)
    assert got == list(np.histogram(values, bins=bins)[0])


def test_histogram_drops_rows_with_a_gap(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, None), (2.0, 4.0)], "v double, w double")
    got, _ = frequencies(df, ("v", "w"), 2)
    assert got == [1, 1, 1, 1]


def test_histogram_of_nothing(spark):
    got, lower = frequencies(spark.createDataFrame([], "v double"), bins=4)
    assert got == [0] * 4 and lower == [0.0, 0.25, 0.5, 0.75]


def test_correlations_equal_pandas(spark):
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"a": rng.normal(size=500), "c": 3.0})
    frame["b"] = frame["a"] * 0.5 + rng.normal(size=500)
    frame["g"] = frame["b"] + rng.normal(size=500)
    df = spark.createDataFrame(frame)
    gap = frame["g"] > 1
    frame.loc[gap, "g"] = np.nan
    df = df.selectExpr("a", "b", "c", "CASE WHEN g <= 1 THEN g END AS g")
    expected = frame.corr()
    rows = correlation_matrix(df, ["a", "b", "c", "g"]).collect()
    assert len(rows) == 16
    for r in rows:
        want = expected.loc[r["row_name"], r["column_name"]]
        if np.isnan(want):
            assert r["r"] is None
        else:
            assert r["r"] == pytest.approx(want, abs=1e-12)
    by_pair = {(r["row_name"], r["column_name"]): r["r"] for r in rows}
    assert all(by_pair[a, b] == by_pair[b, a] for a, b in by_pair)


def test_correlation_of_a_pair_constant_where_both_are_present(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0), (1.0, 2.0), (5.0, None)], "a double, b double"
    )
    rows = {(r[0], r[1]): r[2] for r in correlation_matrix(df, ["a", "b"]).collect()}
    assert rows["a", "b"] is None and rows["a", "a"] == 1.0


def test_density_integrates_to_about_one(spark):
    values = np.random.default_rng(4).normal(size=2000).round(2)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    curve = density_curve(df, "v").toPandas()
    assert len(curve) == 200
    h = values.std(ddof=1) * len(values) ** (-1 / 5)
    grid = np.linspace(values.min(), values.max(), 200)
    z = (grid[:, None] - values[None, :]) / h
    want = np.exp(-0.5 * z**2).sum(axis=1) / (len(values) * h * np.sqrt(2 * np.pi))
    assert curve["x"].to_numpy() == pytest.approx(grid)
    assert curve["density"].to_numpy() == pytest.approx(want)


def test_density_without_spread_is_empty(spark):
    assert density_curve(spark.createDataFrame([(1.0,)] * 3, "v double"), "v").count() == 0
    assert density_curve(spark.createDataFrame([], "v double"), "v").count() == 0


WAITS = "PULocationZone string, PUBorough string, request_hour int, is_weekend int, wait_minutes double"


@pytest.fixture()
def waits(spark):
    rows = [(f"Z{i % 12}", "B", i % 3, i % 2, float(i)) for i in range(240)]
    return spark.createDataFrame(rows, WAITS)


def test_zone_means(waits):
    means = mean_wait_by_zone(waits).toPandas()
    assert list(means["avg_wait_minutes"]) == sorted(means["avg_wait_minutes"], reverse=True)
    top = top_zones(waits).collect()
    assert len(top) == 10 and top[0]["formatted_zone"] == "(B) Z11"


def test_hourly_series_equals_long_form(waits):
    long = {
        (r["request_hour"], r["is_weekend"]): r["avg_wait_minutes"]
        for r in mean_wait_by_hour(waits).collect()
    }
    for r in hourly_series(waits).collect():
        assert r["weekday_wait"] == long[r["request_hour"], 0]
        assert r["weekend_wait"] == long[r["request_hour"], 1]


def test_describe_equals_pandas(waits):
    want = waits.toPandas()["wait_minutes"].describe()
    got = describe(waits).first().asDict()
    names = {"p25": "25%", "p50": "50%", "p75": "75%"}
    for name, value in got.items():
        assert value == pytest.approx(want[names.get(name, name)])


def test_describe_nothing(spark):
    got = describe(spark.createDataFrame([], "wait_minutes double")).first()
    assert got["count"] == 0 and got["p50"] is None


def test_metrics(spark):
    label, prediction = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame(pd.DataFrame({"label": label, "prediction": prediction}))
    got = regression_metrics(df).first()
    error = prediction - label
    assert got["mse"] == pytest.approx((error**2).mean())
    assert got["rmse"] == pytest.approx(np.sqrt((error**2).mean()))
    assert got["mae"] == pytest.approx(np.abs(error).mean())
    assert got["r2"] == pytest.approx(1 - (error**2).sum() / ((label - label.mean()) ** 2).sum())
    assert with_residual(df).agg({"residual": "sum"}).first()[0] == pytest.approx(error.sum())


def test_r2_of_equal_labels_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "label double, prediction double")
    assert regression_metrics(df).first()["r2"] is None


def test_comparison_table(spark):
    rows = [("a", 1000.0, 3500.0), ("a", 2.0, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 3.5)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double")
    table = compare_models(df, ["b", "a"])
    assert table.columns == ["metric", "b", "a"]
    got = [tuple(r) for r in table.collect()]
    assert [r[0] for r in got] == ["MSE", "RMSE", "MAE", "R²"]
    assert got[0] == ("MSE", "0.1250", "3125000.0000")


def test_mean_predictor_knows_only_training_rows(spark):
    train = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 9.0)], "k int, y double")
    test = spark.createDataFrame([(1, 0.0), (2, 0.0), (3, 0.0), (None, 0.0)], "k int, y double")
    rows = {r["k"]: r["prediction"] for r in predict_by_mean(train, test, "k", "y").collect()}
    assert rows == {1: 3.0, 2: 9.0, 3: 5.0, None: 5.0}
