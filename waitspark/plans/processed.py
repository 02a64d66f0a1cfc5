"""From trips, weather and zones to the processed table.

The trips are read twice: once reduced to counts of the combinations that the dictionary, the null
report and the fences need, and once for the result, which joins broadcast dimensions and filters
by literal bounds, without any shuffle of trips.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.functions.text import UNSIGNED_INTEGER, extract_number
from waitspark.functions.times import (
    trip_calendar,
    trip_time_parts,
    wait_minutes,
    weather_time_parts,
)
from waitspark.operators.cleaning import (
    all_present,
    dedupe_hourly,
    drop_null_keys,
    drop_time_anomalies,
)
from waitspark.operators.encoding import apply_codes, category_codes
from waitspark.operators.fences import (
    Fences,
    approximate_fences,
    distinct_values,
    fences_from_counts,
)
from waitspark.operators.joins import join_weather, join_zones
from waitspark.schema import (
    FENCE_COLUMNS,
    KEY_COLUMNS,
    PROCESSED_COLUMNS,
    TARGET,
    WEATHER_MEASURES,
)
from waitspark.workspace import materialize


# Columns that follow from a request's date and hour.
HOUR_COLUMNS = [
    "request_date",
    "request_hour",
    "weekday",
    "is_weekend",
    "trip_month",
    "weather_code",
    *WEATHER_MEASURES.values(),
]


@dataclass(frozen=True)
class Processed:
    """The processed table with what its making found out."""

    data: DataFrame
    weather_codes: DataFrame
    null_report: DataFrame
    fences: Fences

    def fence_report(self) -> DataFrame:
        return self.fences.report(self.data.sparkSession)


def prepare_weather(weather: DataFrame) -> DataFrame:
    """One reading per hour, written once: every later use is a small scan."""
    if "weather_timestamp" not in weather.columns:
        weather = weather_time_parts(weather)
    return materialize(dedupe_hourly(weather), "weather")


def weather_numbers(
    df: DataFrame, pattern: str = UNSIGNED_INTEGER, kind: str = "int", default=None
) -> DataFrame:
    """Adds the numeric form of the five weather texts."""
    return df.withColumns(
        {
            number: extract_number(F.col(text), pattern, kind, default)
            for text, number in WEATHER_MEASURES.items()
        }
    )


def place_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Valid trips with request date and hour, zones and the wait."""
    timed = trip_time_parts(drop_time_anomalies(trips))
    return join_zones(timed, zones).withColumn(TARGET, wait_minutes())


def attach_hour(df: DataFrame, weather_hours: DataFrame, **number_options) -> DataFrame:
    """Adds what the request's date and hour decide: the calendar, the weather and its numbers.

    Numbers are read from the weather table, once per hour rather than once per row.
    """
    own = [c for c in ("weather", "weather_code") if c in weather_hours.columns]
    weather = weather_numbers(weather_hours, **number_options).select(
        "weather_date", "weather_hour", *own, *WEATHER_MEASURES.values()
    )
    return trip_calendar(join_weather(df, weather), "request_date")


def enrich(
    trips: DataFrame, weather_hours: DataFrame, zones: DataFrame, **number_options
) -> DataFrame:
    """Valid trips with zones, the wait, the calendar and the weather."""
    return attach_hour(place_trips(trips, zones), weather_hours, **number_options)


def hourly_combinations(
    trips: DataFrame,
    weather_hours: DataFrame,
    zones: DataFrame,
    fence_columns: Sequence[str],
    **number_options,
) -> DataFrame:
    """How many trips share hour, fenced values and completeness, written once.

    Trips are counted before the weather is attached: most fenced columns follow from the hour, so
    the counts need few and narrow keys, and the weather meets a table that is small already.
    """
    own = [c for c in fence_columns if c not in HOUR_COLUMNS]
    own_keys = [c for c in KEY_COLUMNS if c not in HOUR_COLUMNS]
    placed = place_trips(trips, zones)
    placed = placed.withColumn("_placed", all_present(placed, own_keys))
    keys = list(dict.fromkeys(["request_date", "request_hour", "_placed", *own]))
    counts = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counts = attach_hour(counts, weather_hours, **number_options)
    hour_keys = [c for c in HOUR_COLUMNS if c in KEY_COLUMNS and c != "weather_code"]
    complete = F.col("_placed") & all_present(counts, hour_keys)
    measured = [c for c in fence_columns if c != "weather_code"]
    counts = counts.withColumn("complete", complete).select(
        "complete", "weather", *dict.fromkeys(measured), "n"
    )
    return materialize(counts, "combinations")


def build_processed(
    trips: DataFrame,
    weather_hours: DataFrame,
    zones: DataFrame,
    fence_columns: Sequence[str] = FENCE_COLUMNS,
    k: float = 1.5,
    approx: bool = False,
    **number_options,
) -> Processed:
    """The processed table of ``trips``; ``weather_hours`` has one row per hour."""
    counts = hourly_combinations(
        trips, weather_hours, zones, fence_columns, **number_options
    )
    codes = category_codes(counts, "weather")
    kept_rows = F.sum(F.when(F.col("complete"), F.col("n")).otherwise(0))
    null_report = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.coalesce(kept_rows, F.lit(0)).alias("rows_after"),
    ).withColumn("rows_deleted", F.col("rows_before") - F.col("rows_after"))

    # Codes are attached to the hours, so trips never carry or join the weather's text.
    coded_hours = apply_codes(weather_hours, codes, "weather", "weather_code")
    coded = enrich(trips, coded_hours.drop("weather"), zones, **number_options)
    coded = coded.withColumn("weather_code", F.coalesce("weather_code", F.lit(0)))
    coded = drop_null_keys(coded, KEY_COLUMNS).select(PROCESSED_COLUMNS)
    if approx:
        fences = approximate_fences(coded, fence_columns, k)
    else:
        complete = counts.filter("complete")
        # A code per weather text, and 0: no need to attach codes to count them.
        renamed = complete.withColumnRenamed("weather", "weather_code")
        sizes = distinct_values(renamed, fence_columns)
        complete = apply_codes(complete, codes, "weather", "weather_code")
        fences = fences_from_counts(complete, fence_columns, k, sizes=sizes)
    return Processed(fences.apply(coded), codes, null_report, fences)
