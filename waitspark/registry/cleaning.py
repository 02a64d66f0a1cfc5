"""Queries over samples, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark import views
from waitspark.functions.times import trip_time_parts
from waitspark.operators.cleaning import (
    dedupe_hourly,
    drop_null_keys,
    drop_time_anomalies,
    in_time_order,
    keep_day_kind,
    keep_non_negative,
    null_key_report,
    time_anomaly_report,
    unmatched_count,
    valid_readings,
)
from waitspark.operators.fences import drop_numeric_anomalies, iqr_fences
from waitspark.operators.joins import join_weather, join_zones
from waitspark.operators.observed import write_observed
from waitspark.operators.sampling import hash_sample, sample
from waitspark.plans.processed import weather_numbers
from waitspark.registry import common as c
from waitspark.schema import WEATHER_MEASURES
from waitspark.workspace import materialize, scratch_path

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]
# Skewed measures: each fence removes rows, so the order of the fences shows.
SKEWED_COLUMNS = ["volume", "volume_squared", "spread"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NULL_KEYS = ["request_date", "temp_num", "wind_num", "PULocationZone", "DOLocationZone"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "lineitem").select(*LINE_KEYS, *LINE_COLUMNS)


def skewed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = F.col("l_quantity") * F.col("l_extendedprice") / 10000.0
    rows = lines(spark, sf_dir).withColumns(
        {"volume": volume, "volume_squared": volume * volume, "spread": volume / (F.col("l_discount") + 0.005)}
    )
    # NaN, as no value, must not move a fence, and its rows go.
    rows = rows.withColumn("spread", F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise(F.col("spread")))
    return rows.select(*LINE_KEYS, *SKEWED_COLUMNS)


def sample_bernoulli(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a random tenth: rows that the table lacks, rows beyond its own, and whether the share fits."""
    table = views.table(spark, sf_dir, "lineitem").select(*LINE_KEYS)
    taken = materialize(sample(table, 0.1), "sample")
    counts = table.groupBy(*LINE_KEYS).agg(F.count(F.lit(1)).alias("has"))
    drawn = taken.groupBy(*LINE_KEYS).agg(F.count(F.lit(1)).alias("got"))
    n, total = F.coalesce(F.sum("got"), F.lit(0)), F.coalesce(F.sum("has"), F.lit(0))
    return drawn.join(counts, LINE_KEYS, "full").agg(
        F.count_if(F.col("has").isNull()).alias("outside"),
        F.count_if(F.col("got") > F.col("has")).alias("repeated"),
        # Six deviations of a binomial share.
        (F.abs(n - 0.1 * total) <= 6 * F.sqrt(0.09 * total)).alias("share_fits"),
    )


def sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_sample(lines(spark, sf_dir), LINE_KEYS, 0.1).select(*LINE_KEYS)


def anomaly_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_time_anomalies(views.order_trips(spark, sf_dir))


def anomaly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_anomaly_report(views.order_trips(spark, sf_dir))


def observed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three steps remove, counted by the job that writes what they leave."""
    trips = views.order_trips(spark, sf_dir)
    steps = [
        ("time order", in_time_order()),
        ("within 60 days", F.datediff("on_scene_datetime", "request_datetime") <= 60),
        ("first lines", F.when(F.col("line") != 3, F.col("line") < 5)),
    ]
    report = write_observed(trips, steps, scratch_path(spark, "observed"))
    return report.withColumn("percent_removed", F.round("percent_removed", 6))


def iqr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_numeric_anomalies(skewed_lines(spark, sf_dir), SKEWED_COLUMNS)


def iqr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = iqr_fences(skewed_lines(spark, sf_dir), SKEWED_COLUMNS).report(spark)
    bounds = [c.rounded(n) for n in ("lower_bound", "upper_bound", "anomaly_percent")]
    return report.select("step", "column_name", *bounds, "rows_before", "anomaly_rows", "rows_after")


def fence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = c.build(spark, sf_dir).fence_report()
    return report.select("step", "column_name", "rows_before", "anomaly_rows", "rows_after")


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = trip_time_parts(c.trips(spark, sf_dir))
    weather = weather_numbers(c.weather_hours(spark, sf_dir)).select(
        "weather_date", "weather_hour", *WEATHER_MEASURES.values()
    )
    return join_zones(join_weather(trips, weather), views.zones(spark, sf_dir))


def dropna_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_null_keys(joined(spark, sf_dir), NULL_KEYS).select("trip_id", *NULL_KEYS)


def dropna_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_key_report(joined(spark, sf_dir), NULL_KEYS)


def weather_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_hourly(views.weather(spark, sf_dir))


def target_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances of customers, some of them negative, in the place of waits."""
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return keep_non_negative(customers.withColumn("c_acctbal", F.col("c_acctbal") - 3000), "c_acctbal")


def readings_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of which calm ones lack the time and foggy ones the temperature."""
    rows = views.weather(spark, sf_dir)
    time = F.when(F.col("wind") == "No wind", "").otherwise(F.col("time"))
    temp = F.when(F.col("weather") != "Fog.", F.col("temp"))
    return rows.select("reading_id", time.alias("time"), temp.alias("temp"))


def readings_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_readings(readings_with_gaps(spark, sf_dir))


def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips, zones = c.trips(spark, sf_dir), views.zones(spark, sf_dir)
    counts = [
        unmatched_count(trips, key, zones, "LocationID").select(F.lit(key).alias("key"), "unmatched")
        for key in ("PULocationID", "DOLocationID")
    ]
    return counts[0].unionByName(counts[1])


def weekend_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep_day_kind(c.processed(spark, sf_dir), weekend=True)
    return rows.select("request_datetime", "PULocationID", "request_hour", "wait_minutes")


_line_fences, _lines_last = c.fence_ctes("lines", SKEWED_COLUMNS, "f")
LINES = f"""
measured AS (SELECT *, l_quantity * l_extendedprice / 10000.0::DOUBLE AS volume FROM lineitem),
lines AS (
  SELECT {", ".join(LINE_KEYS)}, volume, volume * volume AS volume_squared,
         CASE WHEN l_linenumber <> 7 THEN volume / (l_discount + 0.005::DOUBLE) END AS spread
  FROM measured),
{_line_fences}"""


def report_sql(source: str, columns: list[str], prefix: str, bounds: bool) -> str:
    """The fence report as a UNION of one row per column and one for all."""
    rows, before = [], source
    last = f"{prefix}_{len(columns) - 1}"
    for i, name in enumerate(columns):
        after = f"{prefix}_{i}"
        rows.append(_report_row_sql(i + 1, name, before, after, f"{prefix}_b{i}", bounds))
        before = after
    rows.append(_report_row_sql(0, "(all)", source, last, None, bounds))
    return "\nUNION ALL ".join(rows)


def _report_row_sql(step, name, before, after, edge, bounds) -> str:
    old, new = f"(SELECT count(*) FROM {before})", f"(SELECT count(*) FROM {after})"
    text = f"SELECT {step} AS step, '{name}' AS column_name"
    if bounds:
        for bound in ("lower_bound", "upper_bound"):
            value = f"(SELECT round({bound}, 6) FROM {edge})" if edge else "CAST(NULL AS DOUBLE)"
            text += f", {value} AS {bound}"
        text += f", round(({old} - {new}) * 100.0::DOUBLE / {old}, 6) AS anomaly_percent"
    return f"{text}, {old} AS rows_before, {old} - {new} AS anomaly_rows, {new} AS rows_after"


JOINED = f"""{c.TRIPS}, {c.WEATHER_HOURS}, {c.ZONES},
joined AS (
  SELECT t.*, CAST(request_datetime AS DATE) AS request_date, {c.NUMBERS},
         p.Zone AS PULocationZone, d.Zone AS DOLocationZone
  FROM trips t
  LEFT JOIN weather_hours w
    ON CAST(request_datetime AS DATE) = weather_date AND hour(request_datetime) = weather_hour
  LEFT JOIN zones p ON PULocationID = p.LocationID
  LEFT JOIN zones d ON DOLocationID = d.LocationID)"""
_present = " AND ".join(f"{k} IS NOT NULL" for k in NULL_KEYS)

QUERIES = {
    "observed_report": observed_report,
    "sample_bernoulli": sample_bernoulli,
    "sample_hash": sample_hash,
    "time_anomaly_filter": anomaly_filter,
    "time_anomaly_report": anomaly_report,
    "iqr_filter": iqr_filter,
    "iqr_report": iqr_report,
    "fence_report": fence_report,
    "dropna_keys": dropna_keys,
    "dropna_report": dropna_report,
    "weather_dedupe": weather_dedupe,
    "target_filter": target_filter,
    "valid_readings": readings_kept,
    "unmatched_keys": unmatched,
    "weekend_rows": weekend_rows,
}

ORACLE = {
    "observed_report": c.with_(
        c.ORDER_TRIPS,
        """SELECT CAST(step AS INTEGER) AS step, name, rows_before, rows_before - rows_after AS rows_removed,
       round((rows_before - rows_after) * 100.0::DOUBLE / rows_before, 6) AS percent_removed, rows_after
FROM (
  SELECT unnest([1, 2, 3, 0]) AS step,
         unnest(['time order', 'within 60 days', 'first lines', '(all)']) AS name,
         unnest([n0, n1, n2, n0]) AS rows_before, unnest([n1, n2, n3, n3]) AS rows_after
  FROM (SELECT count(*) AS n0, count(*) FILTER (WHERE a) AS n1, count(*) FILTER (WHERE a AND b) AS n2,
               count(*) FILTER (WHERE a AND b AND line < 5 AND line <> 3) AS n3
        FROM (SELECT line, request_datetime <= on_scene_datetime AS a,
                     date_diff('day', CAST(request_datetime AS DATE), CAST(on_scene_datetime AS DATE)) <= 60 AS b
              FROM order_trips)))""",
    ),
    "sample_bernoulli": "SELECT CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS repeated, true AS share_fits",
    "sample_hash": f"""SELECT {", ".join(LINE_KEYS)} FROM lineitem
WHERE {c.unit_sql(LINE_KEYS)} < 0.1""",
    "time_anomaly_filter": c.with_(
        c.ORDER_TRIPS,
        "SELECT * FROM order_trips WHERE request_datetime <= on_scene_datetime",
    ),
    "time_anomaly_report": c.with_(
        c.ORDER_TRIPS,
        """SELECT total_rows, total_rows - kept_rows AS anomaly_rows,
       (total_rows - kept_rows) * CAST(100 AS DOUBLE) / total_rows AS anomaly_percent, kept_rows
FROM (SELECT count(*) AS total_rows,
             count(*) FILTER (WHERE request_datetime <= on_scene_datetime) AS kept_rows
      FROM order_trips)""",
    ),
    "iqr_filter": c.with_(LINES, f"SELECT * FROM {_lines_last}"),
    "iqr_report": c.with_(LINES, report_sql("lines", SKEWED_COLUMNS, "f", True)),
    "fence_report": c.with_(
        c.PROCESSED, report_sql("complete", c.FENCE_COLUMNS, "fenced", False)
    ),
    "dropna_keys": c.with_(
        JOINED, f"SELECT trip_id, {', '.join(NULL_KEYS)} FROM joined WHERE {_present}"
    ),
    "dropna_report": c.with_(
        JOINED,
        f"""SELECT rows_before, rows_after, rows_before - rows_after AS rows_deleted
FROM (SELECT count(*) AS rows_before, count(*) FILTER (WHERE {_present}) AS rows_after
      FROM joined)""",
    ),
    "weather_dedupe": c.with_(c.WEATHER_HOURS, "SELECT * FROM weather_hours"),
    "target_filter": """SELECT c_custkey, c_acctbal - 3000 AS c_acctbal FROM customer
WHERE c_acctbal - 3000 >= 0""",
    "valid_readings": c.with_(
        c.WEATHER,
        """SELECT reading_id, time, temp FROM weather
WHERE wind <> 'No wind' AND weather <> 'Fog.'""",
    ),
    "unmatched_keys": c.with_(
        f"{c.TRIPS}, {c.ZONES}",
        """SELECT 'PULocationID' AS key, count(*) AS unmatched FROM (
  SELECT DISTINCT PULocationID FROM trips
  WHERE NOT EXISTS (SELECT 1 FROM zones WHERE LocationID = PULocationID))
UNION ALL
SELECT 'DOLocationID', count(*) FROM (
  SELECT DISTINCT DOLocationID FROM trips
  WHERE NOT EXISTS (SELECT 1 FROM zones WHERE LocationID = DOLocationID))""",
    ),
    "weekend_rows": c.with_(
        c.PROCESSED,
        """SELECT request_datetime, PULocationID, request_hour, wait_minutes FROM processed
WHERE is_weekend = 1""",
    ),
}
