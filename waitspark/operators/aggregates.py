"""Mean waits by place and time, and a summary of the wait itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.functions.text import zone_label
from waitspark.operators.quantiles import exact_quantiles
from waitspark.schema import TARGET

# Fixed value: length of the zone ranking.
TOP_ZONES = 10


def mean_wait(df: DataFrame, *keys: str, name: str = "avg_wait_minutes") -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(TARGET).alias(name))


def mean_wait_by_zone(df: DataFrame) -> DataFrame:
    """By pickup zone and borough, longest first; zones of one name and borough are one."""
    means = mean_wait(df, "PULocationZone", "PUBorough")
    return means.orderBy(F.desc("avg_wait_minutes"), "PULocationZone", "PUBorough")


def top_zones(df: DataFrame, n: int = TOP_ZONES) -> DataFrame:
    """The ``n`` zones with the longest mean wait, labelled "(borough) zone"."""
    label = zone_label(F.col("PUBorough"), F.col("PULocationZone"))
    return mean_wait_by_zone(df).limit(n).withColumn("formatted_zone", label)


def mean_wait_by_month(df: DataFrame) -> DataFrame:
    return mean_wait(df, "trip_month", name="avg_wait").orderBy("trip_month")


def mean_wait_by_hour(df: DataFrame) -> DataFrame:
    """By request hour and kind of day."""
    means = mean_wait(df, "request_hour", "is_weekend")
    return means.orderBy("request_hour", "is_weekend")


def hourly_series(df: DataFrame) -> DataFrame:
    """One row per hour, weekdays and weekends side by side, in a single aggregate."""
    weekend = F.col("is_weekend") == 1
    means = df.groupBy("request_hour").agg(
        F.avg(F.when(~weekend, F.col(TARGET))).alias("weekday_wait"),
        F.avg(F.when(weekend, F.col(TARGET))).alias("weekend_wait"),
    )
    return means.orderBy("request_hour")


def describe(df: DataFrame, column: str = TARGET) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, as one row."""
    head = df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.approx_count_distinct(column).alias("values"),
    ).first()
    _, quartiles = exact_quantiles(
        df, column, (0.25, 0.5, 0.75), distinct_values=head["values"]
    )
    row = {name: head[name] for name in ("count", "mean", "std", "min")}
    row.update(zip(("p25", "p50", "p75"), quartiles or [None] * 3))
    row["max"] = head["max"]
    kinds = ["count long", *[f"`{name}` double" for name in row if name != "count"]]
    values = [v if k == "count" or v is None else float(v) for k, v in row.items()]
    return df.sparkSession.createDataFrame([tuple(values)], ", ".join(kinds))
