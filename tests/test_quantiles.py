"""Exact quantiles and fences against NumPy, on every path."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from waitspark.operators import quantiles
from waitspark.operators.fences import drop_numeric_anomalies, iqr_fences
from waitspark.operators.quantiles import CUTS, exact_quantiles, narrow, value_counts

PROBS = (0.25, 0.5, 0.75)


def shapes() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    hot = rng.normal(size=6000)
    hot[:2000] = np.quantile(hot, 0.25)
    return {
        "spread": rng.normal(size=6001),
        "hot value at a quartile": hot,
        "hot greatest value": np.concatenate([rng.uniform(size=3000), np.full(4000, 2.0)]),
        "heavy tail": rng.pareto(0.5, size=5000),
        "two values": np.repeat([1.0, 5.0], [10, 31]),
        "one value": np.full(17, 3.5),
        "one row": np.array([4.25]),
    }


@pytest.mark.parametrize("shape", shapes())
@pytest.mark.parametrize("limit", [quantiles.VALUE_LIMIT, 1])
def test_exact_quantiles(spark, shape, limit):
    values = shapes()[shape]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    rows, got = exact_quantiles(df, "v", PROBS, value_limit=limit)
    assert rows == len(values)
    assert got == pytest.approx(np.quantile(values, PROBS), abs=1e-12)


def test_value_counts_path(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "TASK_VALUE_LIMIT", 0)
    values = np.arange(999) % 100
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    assert exact_quantiles(df, "v", PROBS)[1] == list(np.quantile(values, PROBS))


def test_narrow_leaves_few_values(spark):
    df = spark.range(20_000).select((F.col("id") * 0.5).alias("v"))
    counts = value_counts(df, "v").cache()
    whole = quantiles.Bracket(0.0, 9999.5, 20_000)
    cuts = [2000.0, 2500.0, 5000.0, 8000.0]
    found = narrow(counts, [4999.75, 14999.25], whole, 2 * CUTS, cuts)
    assert len(found) == 2 and all(b.values <= 2 * CUTS for b in found)


def test_weights_and_nulls(spark):
    df = spark.createDataFrame([(1.0, 3), (None, 5), (9.0, 1)], "v double, n long")
    assert exact_quantiles(df, "v", (0.5, 1.0), "n") == (9, [1.0, 9.0])


def test_no_values(spark):
    empty = spark.createDataFrame([], "v double")
    assert exact_quantiles(empty, "v") == (0, None)
    nulls = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(nulls, "v") == (1, None)
    assert exact_quantiles(nulls, "v", value_limit=0) == (1, None)


def fenced_by_pandas(frame: pd.DataFrame, columns) -> pd.DataFrame:
    for c in columns:
        q1, q3 = frame[c].quantile([0.25, 0.75])
        reach = 1.5 * (q3 - q1)
        frame = frame[(frame[c] >= q1 - reach) & (frame[c] <= q3 + reach)]
    return frame


@pytest.mark.parametrize("limit", [quantiles.VALUE_LIMIT, 1])
@pytest.mark.parametrize("columns", [["a", "b", "c"], ["c", "b", "a"]])
def test_fences_follow_the_column_order(spark, columns, limit):
    rng = np.random.default_rng(3)
    a = rng.standard_t(2, size=3000)
    frame = pd.DataFrame(
        {"a": a, "b": a + rng.standard_t(2, size=3000), "c": rng.integers(0, 9, 3000)}
    )
    frame.loc[:9, "c"] = 99
    frame.loc[5:20, "b"] = np.nan
    expected = fenced_by_pandas(frame, columns)
    df = spark.createDataFrame(frame).select(
        "a", F.nanvl("b", F.lit(None)).alias("b"), "c"
    )
    fences = iqr_fences(df, columns, value_limit=limit)
    got = fences.apply(df).toPandas()
    assert sorted(got["a"]) == pytest.approx(sorted(expected["a"]), abs=0)
    report = {r["column_name"]: r for r in fences.report(spark).collect()}
    assert report[columns[0]]["rows_before"] == 3000
    assert report["(all)"]["rows_after"] == len(expected)
    for before, after in zip(columns, columns[1:]):
        assert report[before]["rows_after"] == report[after]["rows_before"]


def test_zero_range_keeps_one_value(spark):
    df = spark.createDataFrame([(5,)] * 8 + [(6,)], "v int")
    assert {r["v"] for r in drop_numeric_anomalies(df, ["v"]).collect()} == {5}


def test_fences_of_nothing(spark):
    empty = spark.createDataFrame([], "v double, w double")
    fences = iqr_fences(empty, ["v", "w"])
    assert fences.apply(empty).count() == 0
    assert [r["rows_after"] for r in fences.report(spark).collect()] == [0, 0, 0]


def test_approximate_fences_are_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("v"))
    exact = iqr_fences(df, ["v"]).steps[0]
    approx = iqr_fences(df, ["v"], approx=True).steps[0]
    assert approx.lower == pytest.approx(exact.lower, abs=500)
    assert approx.upper == pytest.approx(exact.upper, abs=500)


def test_fences_do_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame(pd.DataFrame({"v": rng.normal(size=2000)}))
    found = {
        (f.lower, f.upper)
        for n in (1, 4, 7)
        for f in iqr_fences(df.repartition(n), ["v"]).steps
    }
    assert len(found) == 1


@pytest.mark.parametrize("value_limit", [1, 100_000])
def test_nan_is_no_value(spark, value_limit):
    rows = [(float(i), float(i)) for i in range(100)] + [(float("nan"), 1e6)] * 10
    df = spark.createDataFrame(rows, "a double, b double")
    fences = iqr_fences(df, ["a", "b"], value_limit=value_limit)
    assert [s.rows_before for s in fences.steps] == [110, 100] and fences.rows_after == 100
    assert fences.steps[1].lower == pytest.approx(-49.5) and fences.steps[1].upper == pytest.approx(148.5)
    assert fences.apply(df).count() == 100


@pytest.mark.parametrize("value_limit", [1, 100_000])
def test_infinite_values(spark, value_limit):
    values = [float("-inf"), *map(float, range(1000)), float("inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    n, found = exact_quantiles(df, "a", (0.25, 0.5, 0.75), value_limit=value_limit)
    assert n == len(values)
    assert found == pytest.approx(list(np.quantile(values, (0.25, 0.5, 0.75))))
