"""Queries over projections, scalar functions and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark import views
from waitspark.functions import (
    SIGNED_DECIMAL,
    clean_time,
    extract_number,
    merge_datetime,
    trip_calendar,
    trip_time_parts,
    url_param_date,
    wait_minutes,
    weather_time_parts,
)
from waitspark.operators.aggregates import mean_wait_by_zone
from waitspark.operators.encoding import encode_category
from waitspark.operators.joins import join_weather, join_zones, zone_map, zone_role
from waitspark.operators.metrics import with_residual
from waitspark.plans.processed import weather_numbers
from waitspark.registry import common as c
from waitspark.schema import PROCESSED_COLUMNS, WEATHER_MEASURES
from waitspark.workspace import materialize


def weather_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth kind of reading has no readable time."""
    rows = views.weather(spark, sf_dir)
    text = F.when(F.col("weather") == "Fog.", "not a time").otherwise(F.col("row_index"))
    rows = rows.select("reading_id", text.alias("row_index"))
    return weather_time_parts(rows)


def trip_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = trip_time_parts(c.trips(spark, sf_dir))
    return parts.select("trip_id", "request_date", "request_hour")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trip_calendar(views.order_trips(spark, sf_dir))
    return rows.select("order_id", "line", "weekday", "is_weekend", "trip_month")


def zone_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = views.zones(spark, sf_dir)
    pickup, drop_off = zone_role(zones, "PU"), zone_role(zones, "DO")
    same = pickup["PULocationID"] == drop_off["DOLocationID"]
    return pickup.join(drop_off, same)


def numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weather_numbers(views.weather(spark, sf_dir))
    return rows.select("reading_id", *WEATHER_MEASURES.values())


def signed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign and fraction kept, calm wind as 0."""
    rows = views.weather(spark, sf_dir)
    frost = F.concat(F.lit("-"), F.col("temp"))
    return rows.select(
        "reading_id",
        extract_number(frost, SIGNED_DECIMAL, "double").alias("temp_num"),
        extract_number(F.col("wind"), SIGNED_DECIMAL, "double", 0).alias("wind_num"),
        extract_number(F.col("barometer"), SIGNED_DECIMAL, "double").alias("barometer_num"),
    )


def trips_with_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = trip_time_parts(c.trips(spark, sf_dir))
    weather = c.weather_hours(spark, sf_dir).select("weather_date", "weather_hour", "temp", "weather")
    return join_weather(trips, weather)


def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = encode_category(trips_with_weather(spark, sf_dir), "weather", "weather_code")
    return rows.select("trip_id", "weather", "weather_code")


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_category(trips_with_weather(spark, sf_dir), "weather", "weather_code")[1]


def waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = c.trips(spark, sf_dir)
    return trips.select("trip_id", wait_minutes().alias("wait_minutes"))


def projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.processed(spark, sf_dir).select(PROCESSED_COLUMNS)


def raw_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time cells in the shapes that pages show them in."""
    rows = views.weather(spark, sf_dir)
    raw = (
        F.when(F.col("weather") == "Clear.", F.concat(views.half_day_clock(), F.lit("\nMon, Jan 1")))
        .when(F.col("weather") == "Fog.", F.concat(F.lit(" "), F.col("time"), F.lit("\n")))
        .when(F.col("weather") == "Overcast.", "")
        .otherwise("no data")
    )
    return rows.select("reading_id", "date", raw.alias("raw"))


def times_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_times(spark, sf_dir).select(
        "reading_id",
        clean_time(F.col("raw")).alias("time"),
        clean_time(F.col("raw"), keep_meridiem=False).alias("bare_time"),
    )


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_times(spark, sf_dir)
    time = clean_time(F.col("raw"))
    return rows.select("reading_id", merge_datetime(F.col("date"), time).alias("row_index"))


def param_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page parameter, eight digits after padding, and the path where it is absent."""
    pages = views.table(spark, sf_dir, "pages")
    padded = F.regexp_replace("url", r"(?<=[?&]page=)(?=\d(?:[&#]|$))", "2024010")
    date = url_param_date(padded, F.regexp_extract("url", r"^[^?#]*", 0), "page")
    return pages.select("page_id", date.alias("date"))


def residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_residual(c.mean_predictions(spark, sf_dir))
    return rows.select("model", "label", "prediction", c.rounded("residual"))


def weather_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trips_with_weather(spark, sf_dir)
    return rows.select("trip_id", "request_date", "request_hour", "temp", "weather")


def zones_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_zones(c.trips(spark, sf_dir), views.zones(spark, sf_dir))


def shapes_with_waits(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_wait_by_zone(c.processed(spark, sf_dir))
    means = means.select("PULocationZone", c.rounded("avg_wait_minutes"))
    return zone_map(views.shapes(spark, sf_dir), materialize(means, "means"))


RAW_TIMES = f"""{c.WEATHER},
clocks AS (
  SELECT reading_id, date, weather, time,
         ((weather_hour + 11) % 12 + 1) || strftime(weather_timestamp, ':%M') AS bare,
         CASE WHEN weather_hour < 12 THEN ' am' ELSE ' pm' END AS half
  FROM weather)"""
TIME = """CASE weather WHEN 'Clear.' THEN bare || half WHEN 'Fog.' THEN time
     WHEN 'Overcast.' THEN '' ELSE 'no data' END"""
WITH_WEATHER = f"""{c.TRIPS}, {c.WEATHER_HOURS},
with_weather AS (
  SELECT trip_id, CAST(request_datetime AS DATE) AS request_date,
         CAST(hour(request_datetime) AS INTEGER) AS request_hour, w.temp, w.weather
  FROM trips LEFT JOIN weather_hours w
    ON CAST(request_datetime AS DATE) = weather_date AND hour(request_datetime) = weather_hour),
codes AS (
  SELECT weather, CAST(row_number() OVER (ORDER BY weather) AS INTEGER) AS code
  FROM (SELECT DISTINCT weather FROM with_weather WHERE weather IS NOT NULL))"""
_calendar = c.calendar_sql()
_numbers = ", ".join(f"{c.number_sql(t)} AS {n}" for t, n in WEATHER_MEASURES.items())

QUERIES = {
    "weather_time_parts": weather_times,
    "trip_time_parts": trip_times,
    "trip_calendar": calendar,
    "zone_roles": zone_roles,
    "weather_numbers": numbers,
    "weather_numbers_signed": signed_numbers,
    "encode_weather": encoded,
    "weather_mapping": mapping,
    "wait_minutes": waits,
    "processed_projection": projection,
    "clean_time": times_cleaned,
    "merge_datetime": merged,
    "url_param_date": param_date,
    "residuals": residuals,
    "join_weather": weather_join,
    "join_zones": zones_join,
    "zone_map": shapes_with_waits,
}

ORACLE = {
    "weather_time_parts": c.with_(
        c.WEATHER,
        """SELECT reading_id, CASE WHEN foggy THEN 'not a time' ELSE row_index END AS row_index,
       CASE WHEN NOT foggy THEN date_trunc('minute', weather_timestamp) END AS weather_timestamp,
       CASE WHEN NOT foggy THEN weather_date END AS weather_date,
       CASE WHEN NOT foggy THEN weather_hour END AS weather_hour
FROM (SELECT *, weather = 'Fog.' AS foggy FROM weather)""",
    ),
    "trip_time_parts": c.with_(
        c.TRIPS,
        """SELECT trip_id, CAST(request_datetime AS DATE) AS request_date,
       CAST(hour(request_datetime) AS INTEGER) AS request_hour FROM trips""",
    ),
    "trip_calendar": c.with_(
        c.ORDER_TRIPS,
        f"""SELECT order_id, line, weekday, is_weekend, trip_month
FROM (SELECT *, {_calendar} FROM order_trips)""",
    ),
    "zone_roles": c.with_(
        c.ZONES,
        """SELECT LocationID AS PULocationID, Zone AS PULocationZone, Borough AS PUBorough,
       LocationID AS DOLocationID, Zone AS DOLocationZone, Borough AS DOBorough FROM zones""",
    ),
    "weather_numbers": c.with_(c.WEATHER, f"SELECT reading_id, {_numbers} FROM weather"),
    "weather_numbers_signed": c.with_(
        c.WEATHER,
        """SELECT reading_id, CAST(-k AS DOUBLE) AS temp_num,
       CAST(CASE WHEN k % 10 = 0 THEN 0 ELSE k % 30 END AS DOUBLE) AS wind_num,
       CAST('30.' || k AS DOUBLE) AS barometer_num
FROM weather JOIN signups ON reading_id = event_id""",
    ),
    "encode_weather": c.with_(
        WITH_WEATHER,
        """SELECT trip_id, w.weather, coalesce(code, 0) AS weather_code
FROM with_weather w LEFT JOIN codes c ON w.weather = c.weather""",
    ),
    "weather_mapping": c.with_(WITH_WEATHER, "SELECT weather, code FROM codes"),
    "wait_minutes": c.with_(
        c.TRIPS, f"SELECT trip_id, {c.wait_sql()} AS wait_minutes FROM trips"
    ),
    "processed_projection": c.with_(
        c.PROCESSED, f"SELECT {', '.join(PROCESSED_COLUMNS)} FROM processed"
    ),
    "clean_time": c.with_(
        RAW_TIMES,
        f"""SELECT reading_id, {TIME} AS time, replace(replace({TIME}, ' am', ''), ' pm', '')
       AS bare_time FROM clocks""",
    ),
    "merge_datetime": c.with_(
        RAW_TIMES,
        f"""SELECT reading_id, CASE WHEN {TIME} = '' THEN '' ELSE date || ' ' || {TIME} END
       AS row_index FROM clocks""",
    ),
    "url_param_date": r"""
SELECT page_id,
       CASE WHEN length(value) = 1 THEN '2024-01-0' || value
            WHEN length(value) = 8 THEN substr(value, 1, 4) || '-' || substr(value, 5, 2) || '-'
                                        || substr(value, 7, 2)
            ELSE regexp_extract(url, '^[^?#]*') END AS date
FROM (SELECT page_id, url, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS value FROM pages)""",
    "residuals": c.with_(
        c.PREDICTIONS,
        """SELECT model, label, prediction, round(prediction - label, 6) AS residual
FROM predictions""",
    ),
    "join_weather": c.with_(WITH_WEATHER, "SELECT * FROM with_weather"),
    "join_zones": c.with_(
        f"{c.TRIPS}, {c.ZONES}",
        """SELECT t.*, p.Zone AS PULocationZone, p.Borough AS PUBorough,
       d.Zone AS DOLocationZone, d.Borough AS DOBorough
FROM trips t LEFT JOIN zones p ON PULocationID = p.LocationID
LEFT JOIN zones d ON DOLocationID = d.LocationID""",
    ),
    "zone_map": c.with_(
        f"""{c.PROCESSED},
shapes AS (
  SELECT n_nationkey AS shape_id, 'NATION_' || (n_nationkey % 20) AS zone FROM nation),
means AS (
  SELECT PULocationZone, round(avg(wait_minutes), 6) AS avg_wait_minutes
  FROM processed GROUP BY PULocationZone, PUBorough)""",
        """SELECT shape_id, zone, PULocationZone, coalesce(avg_wait_minutes, 0) AS avg_wait_minutes
FROM shapes LEFT JOIN means ON zone = PULocationZone""",
    ),
}
