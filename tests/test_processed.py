"""The whole pipeline: known counts, plans and edge cases."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM
from waitspark import views
from waitspark.plans import build_processed, chart_tables, prepare_weather
from waitspark.registry import common
from waitspark.schema import PROCESSED_COLUMNS, TRIP_SCHEMA
from waitspark.workspace import materialize

# Fence order for which the counts below are known.
ORDER = [
    "weather_code",
    "temp_num",
    "wind_num",
    "request_hour",
    "weekday",
    "trip_month",
    "wait_minutes",
]


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture(scope="module")
def inputs(spark):
    return (
        common.trips(spark, MEDIUM),
        common.weather_hours(spark, MEDIUM),
        views.zones(spark, MEDIUM),
    )


@pytest.fixture(scope="module")
def built(inputs):
    return build_processed(*inputs, fence_columns=ORDER)


def test_known_counts(inputs, built):
    assert inputs[0].count() == 7983
    assert tuple(built.null_report.first()) == (7833, 5798, 2035)
    assert built.data.columns == PROCESSED_COLUMNS
    assert built.data.count() == 5493
    waits = built.data.agg(F.min("wait_minutes"), F.max("wait_minutes")).first()
    assert tuple(waits) == (0.2, 2397.1)


def test_approximate_fences_keep_about_as_many(inputs):
    approx = build_processed(*inputs, fence_columns=ORDER, approx=True)
    assert approx.data.count() == pytest.approx(5493, abs=60)


def test_result_does_not_depend_on_partitioning(spark, inputs, built):
    trips, weather, zones = inputs
    again = build_processed(trips.repartition(7), weather, zones, fence_columns=ORDER)
    assert again.fences == built.fences
    assert again.data.exceptAll(built.data).count() == 0


def test_trips_are_not_shuffled_for_the_result(built):
    plan = plan_of(built.data)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    scan = next(part for part in plan.split("\n\n") if "waitspark-trips" in part)
    pushed, columns = (
        next(line for line in scan.splitlines() if line.startswith(name))
        for name in ("PushedFilters", "ReadSchema")
    )
    for key in TRIP_SCHEMA.names:
        assert f"IsNotNull({key})" in pushed and key in columns
    assert "trip_id" not in columns


def test_a_large_dimension_is_joined_by_a_shuffle(spark, inputs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build_processed(*inputs, fence_columns=ORDER)
        assert "BroadcastHashJoin" not in plan_of(shuffled.data)
        assert shuffled.data.count() == 5493
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_trips(spark, inputs):
    empty = spark.createDataFrame([], TRIP_SCHEMA)
    built = build_processed(empty, inputs[1], inputs[2])
    assert built.data.count() == 0
    assert tuple(built.null_report.first()) == (0, 0, 0)
    assert built.weather_codes.count() == 0


def test_weather_text_is_parsed_when_it_has_no_times(spark):
    rows = views.weather_rows(spark, MEDIUM)
    hours = prepare_weather(rows)
    assert hours.count() == prepare_weather(views.weather(spark, MEDIUM)).count()
    assert hours.filter(F.col("weather_timestamp").isNull()).count() == 0


def test_calm_wind_can_be_kept(inputs):
    calm = build_processed(*inputs, fence_columns=ORDER, default=0)
    assert calm.null_report.first()["rows_after"] > 5798


def test_chart_tables(spark, built):
    tables = chart_tables(materialize(built.data, "processed"), views.shapes(spark, MEDIUM))
    assert set(tables) == {
        "histograms", "correlations", "hourly", "top_zones", "monthly", "zone_map",
    }
    assert tables["top_zones"].count() == 10
    assert tables["correlations"].count() == 100
    assert tables["histograms"].agg(F.sum("frequency")).first()[0] == 6 * 5493
