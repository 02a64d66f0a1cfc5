"""Filters of trips and weather, each with a one-pass report of what it removes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; 0 of nothing."""
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def in_time_order() -> Column:
    return F.col("request_datetime") <= F.col("on_scene_datetime")


def drop_time_anomalies(trips: DataFrame) -> DataFrame:
    """Keeps trips requested no later than the arrival; a missing time drops the trip."""
    return trips.filter(in_time_order())


def time_anomaly_report(trips: DataFrame) -> DataFrame:
    counts = trips.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(in_time_order()).alias("kept_rows"),
    )
    removed = F.col("total_rows") - F.col("kept_rows")
    return counts.select(
        "total_rows",
        removed.alias("anomaly_rows"),
        percent(removed, F.col("total_rows")).alias("anomaly_percent"),
        "kept_rows",
    )


def all_present(df: DataFrame, columns: Sequence[str]) -> Column:
    """Whether no column is null, nor NaN if it holds floating numbers.

    One test per column rather than a count of gaps, so that each reaches the scan of its table and
    a left join whose columns must be present becomes an inner one.
    """
    tests = []
    for c in columns:
        tests.append(F.col(c).isNotNull())
        if df.schema[c].dataType.typeName() in ("float", "double"):
            tests.append(~F.isnan(c))
    return reduce(lambda a, b: a & b, tests)


def drop_null_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(all_present(df, columns))


def null_key_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(all_present(df, columns)).alias("rows_after"),
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counts.select("rows_before", "rows_after", removed.alias("rows_deleted"))


def dedupe_hourly(
    weather: DataFrame,
    keys: Sequence[str] = ("weather_date", "weather_hour"),
    order_by: str = "weather_timestamp",
) -> DataFrame:
    """The earliest reading of every hour; ties go by all columns, so the choice is fixed.

    A plain minimum, so each task sends at most one row per hour into the shuffle.
    """
    ranked = [order_by, *[c for c in weather.columns if c not in keys and c != order_by]]
    first = weather.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("first"))
    return first.select(*keys, "first.*").select(*weather.columns)


def keep_non_negative(df: DataFrame, column: str) -> DataFrame:
    """Drops negative values and nulls."""
    return df.filter(F.col(column) >= 0)


def valid_readings(readings: DataFrame) -> DataFrame:
    """Readings with a time and a temperature."""
    return readings.filter((F.length("time") > 0) & (F.length("temp") > 0))


def keep_day_kind(df: DataFrame, weekend: bool) -> DataFrame:
    return df.filter(F.col("is_weekend") == int(weekend))


def unmatched_keys(
    facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    """Distinct fact keys, null among them, that the dimension lacks.

    Keys are made distinct before the join, so a hot key is one row by then.
    """
    keys = facts.select(key).distinct()
    known = dimension.select(dimension_key)
    return keys.join(known, keys[key] == known[dimension_key], "left_anti")


def unmatched_count(
    facts: DataFrame, key: str, dimension: DataFrame, dimension_key: str
) -> DataFrame:
    missing = unmatched_keys(facts, key, dimension, dimension_key)
    return missing.agg(F.count(F.lit(1)).alias("unmatched"))
