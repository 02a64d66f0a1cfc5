"""Time parts of trips and weather, and the wait.

Times stay without zone from reading to result, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Formats of a weather time text, and the weekend days (1 = Sunday).
DAY_TIME = r"^(\d{4}-\d{2}-\d{2}) (\d{1,2}):(\d{2})$"
HALF_DAY_TIME = r"(?i)^(\d{4}-\d{2}-\d{2}) (0?[1-9]|1[0-2]):(\d{2}) ([AP])M$"
WEEKEND = (1, 7)


def weather_time_parts(weather: DataFrame, text: str = "row_index") -> DataFrame:
    """Adds weather_timestamp, weather_date and weather_hour; text that is no time gives null.

    The time is put into one form and cast without a zone, so hours that a zone skips stay.
    """
    part = lambda pattern, i: F.regexp_extract(text, pattern, i)
    afternoon = F.when(F.upper(part(HALF_DAY_TIME, 4)) == "P", 12).otherwise(0)
    hour = (part(HALF_DAY_TIME, 2).try_cast("int") % 12 + afternoon).cast("string")
    half_day = F.concat(part(HALF_DAY_TIME, 1), F.lit(" "), F.lpad(hour, 2, "0"), F.lit(":"), part(HALF_DAY_TIME, 3))
    full_day = F.concat(
        part(DAY_TIME, 1), F.lit(" "), F.lpad(part(DAY_TIME, 2), 2, "0"), F.lit(":"), part(DAY_TIME, 3)
    )
    stamp = F.coalesce(half_day.try_cast("timestamp_ntz"), full_day.try_cast("timestamp_ntz"))
    stamped = weather.withColumn("weather_timestamp", stamp)
    return stamped.withColumns(
        {
            "weather_date": F.to_date("weather_timestamp"),
            "weather_hour": F.hour("weather_timestamp"),
        }
    )


def trip_time_parts(trips: DataFrame) -> DataFrame:
    """Adds request_date and request_hour."""
    return trips.withColumns(
        {
            "request_date": F.to_date("request_datetime"),
            "request_hour": F.hour("request_datetime"),
        }
    )


def trip_calendar(trips: DataFrame, time: str = "request_datetime") -> DataFrame:
    """Adds weekday (1 = Sunday), is_weekend and trip_month of a time or date."""
    weekday = F.dayofweek(time)
    return trips.withColumns(
        {
            "weekday": weekday,
            "is_weekend": F.when(weekday.isin(*WEEKEND), 1).otherwise(0),
            "trip_month": F.month(time),
        }
    )


def wait_minutes(
    start: str = "request_datetime", end: str = "on_scene_datetime"
) -> Column:
    """Minutes between two times, whole seconds first, rounded half up to one decimal."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return F.round(seconds / F.lit(60.0), 1)
