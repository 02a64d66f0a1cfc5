"""Column lists and schemas shared by the whole package."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and orders that results must carry.
KEY_COLUMNS = [
    "on_scene_datetime",
    "request_datetime",
    "request_date",
    "PULocationID",
    "DOLocationID",
    "PULocationZone",
    "DOLocationZone",
    "PUBorough",
    "DOBorough",
    "weather_code",
    "temp_num",
    "wind_num",
    "request_hour",
    "weekday",
    "is_weekend",
    "trip_month",
    "humidity_num",
    "barometer_num",
    "visibility_num",
]
FENCE_COLUMNS = [
    "weather_code",
    "temp_num",
    "wind_num",
    "humidity_num",
    "barometer_num",
    "visibility_num",
    "request_hour",
    "weekday",
    "trip_month",
    "wait_minutes",
]
FEATURES = [
    "weather_code",
    "temp_num",
    "wind_num",
    "humidity_num",
    "barometer_num",
    "visibility_num",
    "PULocationID",
    "request_hour",
    "is_weekend",
]
TARGET = "wait_minutes"
HISTOGRAM_FEATURES = [
    "weather_code",
    "temp_num",
    "wind_num",
    "humidity_num",
    "barometer_num",
    "visibility_num",
]
WEATHER_COLUMNS = [
    "row_index",
    "date",
    "time",
    "temp",
    "weather",
    "wind",
    "humidity",
    "barometer",
    "visibility",
]
# Text measure -> numeric feature.
WEATHER_MEASURES = {
    "temp": "temp_num",
    "wind": "wind_num",
    "humidity": "humidity_num",
    "barometer": "barometer_num",
    "visibility": "visibility_num",
}
SEED = 42

PROCESSED_COLUMNS = [*KEY_COLUMNS, TARGET]

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("request_datetime", T.TimestampNTZType()),
        T.StructField("on_scene_datetime", T.TimestampNTZType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
    ]
)
# Text throughout: inferring types would turn the bare times into timestamps of today.
WEATHER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in WEATHER_COLUMNS])
ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("link_text", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)
