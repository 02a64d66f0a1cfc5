"""What the registered queries share: stored input tables, and the same inputs in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark import views
from waitspark.operators.learning import with_split
from waitspark.operators.metrics import predict_by_mean
from waitspark.plans.processed import Processed, build_processed, prepare_weather
from waitspark.plans.training import Splits, scaled_splits
from waitspark.schema import FENCE_COLUMNS, KEY_COLUMNS, TARGET, WEATHER_MEASURES
from waitspark.workspace import materialize

_stored: dict[tuple[str, str, str], object] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    """The result of ``make``, made once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips as a stored table, as trip files would be."""
    return stored(
        spark, sf_dir, "trips", lambda: materialize(views.trips(spark, sf_dir), "trips")
    )


def weather_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "weather", lambda: prepare_weather(views.weather(spark, sf_dir))
    )


def build(spark: SparkSession, sf_dir: str) -> Processed:
    return build_processed(
        trips(spark, sf_dir), weather_hours(spark, sf_dir), views.zones(spark, sf_dir)
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table as written, which statistics and models read."""
    return stored(
        spark,
        sf_dir,
        "processed",
        lambda: materialize(build(spark, sf_dir).data, "processed"),
    )


def splits(spark: SparkSession, sf_dir: str) -> Splits:
    return stored(
        spark, sf_dir, "splits", lambda: scaled_splits(processed(spark, sf_dir))
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.shapes(spark, sf_dir)


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed rows with a wait that the features decide, but for up to a minute."""
    decided = 5 + F.abs(F.col("request_hour") - 12) + 4 * F.col("is_weekend") + F.col("PULocationID") % 5
    rest = F.minute("request_datetime") % 10 / 10
    return processed(spark, sf_dir).withColumn(TARGET, F.round(decided + rest, 1))


def mean_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, label, prediction) on the test split of the means by hour and by pickup zone."""

    def make() -> DataFrame:
        rows = with_split(processed(spark, sf_dir))
        rows = rows.select("split", "request_hour", "PULocationID", TARGET)
        rows = materialize(rows, "split", ["split"])
        train = rows.filter(F.col("split") == "train")
        test = rows.filter(F.col("split") == "test")
        by_key = [
            predict_by_mean(train, test, key, TARGET).select(
                F.lit(model).alias("model"), "label", rounded("prediction")
            )
            for model, key in (("hour_mean", "request_hour"), ("zone_mean", "PULocationID"))
        ]
        return materialize(by_key[0].unionByName(by_key[1]), "predictions")

    return stored(spark, sf_dir, "mean_predictions", make)


def rounded(name: str, digits: int = 6) -> Column:
    return F.round(name, digits).alias(name)


# The inputs in SQL, as parts of a WITH list.

EVENT_NUMBER = """CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER)"""

TRIPS = f"""
requests AS (
  SELECT event_id AS trip_id, user_id, ts AS request_datetime,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS on_scene_datetime,
         {EVENT_NUMBER} % 30 AS DOLocationID
  FROM events WHERE event_type <> 'signup'),
trips AS (
  SELECT trip_id, request_datetime, on_scene_datetime, c_nationkey AS PULocationID, DOLocationID
  FROM requests JOIN customer ON user_id = c_custkey)"""

ORDER_TRIPS = """
order_trips AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, o_orderdate AS request_datetime,
         l_shipdate AS on_scene_datetime
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

WEATHER = f"""
signups AS (
  SELECT event_id, ts, {EVENT_NUMBER} AS k FROM events WHERE event_type = 'signup'),
weather AS (
  SELECT event_id AS reading_id, ts AS weather_timestamp, CAST(ts AS DATE) AS weather_date,
         CAST(hour(ts) AS INTEGER) AS weather_hour, strftime(ts, '%Y-%m-%d') AS date,
         strftime(ts, '%-H:%M') AS time, k || ' °F' AS temp,
         CASE k % 4 WHEN 0 THEN 'Clear.' WHEN 1 THEN 'Fog.' WHEN 2 THEN 'Overcast.'
                    ELSE 'Light rain.' END AS weather,
         CASE WHEN k % 10 = 0 THEN 'No wind' ELSE (k % 30) || ' mph' END AS wind,
         k || '%' AS humidity, '30.' || k || ' "Hg' AS barometer, (k % 10) || ' mi' AS visibility,
         strftime(ts, '%Y-%m-%d %-H:%M') AS row_index
  FROM signups)"""

WEATHER_HOURS = f"""{WEATHER},
ranked_weather AS (
  SELECT *, row_number() OVER (PARTITION BY weather_date, weather_hour
                               ORDER BY weather_timestamp, reading_id) AS place
  FROM weather),
weather_hours AS (SELECT * EXCLUDE (place) FROM ranked_weather WHERE place = 1)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS LocationID, r_name AS Borough, n_name AS Zone,
         'Service ' || n_regionkey AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


SHAPES = """
shapes AS (
  SELECT n_nationkey AS shape_id, 'NATION_' || (n_nationkey % 20) AS zone FROM nation)"""


def wait_sql(start: str = "request_datetime", end: str = "on_scene_datetime") -> str:
    seconds = f"date_diff('second', date_trunc('second', {start}), date_trunc('second', {end}))"
    return f"round(CAST({seconds} AS DOUBLE) / 60.0, 1)"


def calendar_sql(time: str = "request_datetime") -> str:
    return f"""CAST({time} AS DATE) AS request_date, CAST(hour({time}) AS INTEGER) AS request_hour,
  CAST(dayofweek({time}) + 1 AS INTEGER) AS weekday,
  CASE WHEN dayofweek({time}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
  CAST(month({time}) AS INTEGER) AS trip_month"""


def number_sql(text: str) -> str:
    return f"TRY_CAST(regexp_extract({text}, '([0-9]+)', 1) AS INTEGER)"


NUMBERS = ", ".join(f"{number_sql('w.' + t)} AS {n}" for t, n in WEATHER_MEASURES.items())

ENRICHED = f"""{TRIPS}, {WEATHER_HOURS}, {ZONES},
timed AS (
  SELECT *, {calendar_sql()}, {wait_sql()} AS wait_minutes
  FROM trips WHERE request_datetime <= on_scene_datetime),
enriched AS (
  SELECT t.*, w.weather_date, w.weather, {NUMBERS},
         p.Zone AS PULocationZone, p.Borough AS PUBorough,
         d.Zone AS DOLocationZone, d.Borough AS DOBorough
  FROM timed t
  LEFT JOIN weather_hours w ON request_date = weather_date AND request_hour = weather_hour
  LEFT JOIN zones p ON t.PULocationID = p.LocationID
  LEFT JOIN zones d ON t.DOLocationID = d.LocationID),
codes AS (
  SELECT weather, CAST(row_number() OVER (ORDER BY weather) AS INTEGER) AS code
  FROM (SELECT DISTINCT weather FROM enriched WHERE weather IS NOT NULL)),
coded AS (
  SELECT e.*, coalesce(code, 0) AS weather_code
  FROM enriched e LEFT JOIN codes c ON e.weather = c.weather)"""

PRESENT = " AND ".join(f"{c} IS NOT NULL" for c in KEY_COLUMNS)

COMPLETE = f"""{ENRICHED},
complete AS MATERIALIZED (
  SELECT {", ".join(KEY_COLUMNS)}, wait_minutes FROM coded WHERE {PRESENT})"""


def fence_ctes(source: str, columns: list[str], prefix: str = "fenced") -> tuple[str, str]:
    """(WITH parts that fence column after column, the name of the last one)."""
    parts, before = [], source
    for i, c in enumerate(columns):
        parts.append(
            f"""{prefix}_q{i} AS MATERIALIZED (
  SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {before}),
{prefix}_b{i} AS MATERIALIZED (
  SELECT q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
  FROM {prefix}_q{i}),
{prefix}_{i} AS MATERIALIZED (
  SELECT s.* FROM {before} s, {prefix}_b{i} b
  WHERE s.{c} >= b.lower_bound AND s.{c} <= b.upper_bound)"""
        )
        before = f"{prefix}_{i}"
    return ",\n".join(parts), before


_fences, _last = fence_ctes("complete", FENCE_COLUMNS)
PROCESSED = f"""{COMPLETE},
{_fences},
processed AS MATERIALIZED (SELECT * FROM {_last})"""


def unit_sql(keys: list[str]) -> str:
    text = " || ".join(f"'|' || coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


SPLIT_UNIT = unit_sql(
    ["request_datetime", "on_scene_datetime", "PULocationID", "DOLocationID"]
)
SPLIT = f"""{PROCESSED},
split_rows AS MATERIALIZED (
  SELECT *, CASE WHEN floor({SPLIT_UNIT} * 100) < 60 THEN 'train'
                 WHEN floor({SPLIT_UNIT} * 100) < 80 THEN 'validation'
                 ELSE 'test' END AS split
  FROM processed)"""

PREDICTIONS = f"""{SPLIT},
overall AS (SELECT avg(wait_minutes) AS mean FROM split_rows WHERE split = 'train'),
hour_means AS (
  SELECT request_hour, avg(wait_minutes) AS mean FROM split_rows
  WHERE split = 'train' GROUP BY request_hour),
zone_means AS (
  SELECT PULocationID, avg(wait_minutes) AS mean FROM split_rows
  WHERE split = 'train' GROUP BY PULocationID),
predictions AS MATERIALIZED (
  SELECT 'hour_mean' AS model, wait_minutes AS label,
         round(coalesce(h.mean, (SELECT mean FROM overall)), 6) AS prediction
  FROM split_rows s LEFT JOIN hour_means h ON s.request_hour = h.request_hour
  WHERE split = 'test'
  UNION ALL
  SELECT 'zone_mean', wait_minutes, round(coalesce(z.mean, (SELECT mean FROM overall)), 6)
  FROM split_rows s LEFT JOIN zone_means z ON s.PULocationID = z.PULocationID
  WHERE split = 'test')"""


def with_(parts: str, select: str) -> str:
    return f"WITH {parts.strip()}\n{select}"
