"""Queries over sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark import views
from waitspark.functions.text import cell_text
from waitspark.plans.weather import weather_readings
from waitspark.registry import common as c
from waitspark.schema import PAGE_SCHEMA, WEATHER_SCHEMA
from waitspark.sources import (
    append_csv,
    append_in_batches,
    append_months,
    count_csv,
    file_counts,
    files_over,
    html_rows,
    pages_with_param,
    preview,
    read_months,
    read_processed,
    read_trips,
    read_weather,
    read_zones,
    sample_files,
    stage_batch,
    table_rows,
    top_elements,
    write_processed,
)
from waitspark.streaming import stream_weather
from waitspark.workspace import discard, materialize, scratch_path

# Rows of a file of a batch: fewer than any task has.
BATCH_ROWS = 500
COUNT_KEYS = ["o_orderkey", "l_orderkey", "l_linenumber"]


def scan_union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two month directories whose columns differ in order and width, read as one table."""
    path = scratch_path(spark, "months")
    trips = c.trips(spark, sf_dir)
    early = F.dayofmonth("request_datetime") <= 15
    narrow = trips.withColumn("DOLocationID", F.col("DOLocationID").cast("int"))
    narrow.filter(early).write.parquet(f"{path}/early.parquet")
    late = trips.filter(~early).withColumn("DOLocationID", F.col("DOLocationID").cast("long"))
    late.select(*reversed(trips.columns)).write.parquet(f"{path}/late.parquet")
    found = read_trips(spark, path).select(trips.columns)
    return found.withColumn("DOLocationID", F.col("DOLocationID").cast("int"))


def count_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem")]
    found = file_counts(read_trips(spark, paths, file="file_path"), COUNT_KEYS, 0.1)
    return found.drop("file_path")


def weather_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    append_csv(views.weather_rows(spark, sf_dir), path)
    return read_weather(spark, path)


def zones_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    zones = views.zones(spark, sf_dir)
    append_csv(zones.select("LocationID", "Borough", "Zone", "service_zone"), path)
    return read_zones(spark, path)


def processed_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "processed")
    write_processed(c.processed(spark, sf_dir), path, ["trip_month"])
    return read_processed(spark, path)


def write_read_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write replaces the first."""
    path = scratch_path(spark, "processed")
    trips = c.trips(spark, sf_dir)
    write_processed(trips.filter(F.col("on_scene_datetime").isNull()), path)
    write_processed(trips, path)
    return read_processed(spark, path)


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "batches")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    append_in_batches(orders, path, BATCH_ROWS)
    append_in_batches(orders.filter(F.col("o_totalprice") > 200000), path, BATCH_ROWS)
    return spark.read.parquet(path)


def months_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in two batches: the second is stopped before its commit, then run whole; the first is run again."""
    path = scratch_path(spark, "months")
    rows = views.order_trips(spark, sf_dir)
    rows = materialize(rows.select("order_id", "line", F.month("request_datetime").alias("trip_month")), "order-trips")
    early, late = rows.filter("trip_month <= 6"), rows.filter("trip_month >= 6")
    append_months(early, path, "early", batch_size=BATCH_ROWS)
    stage_batch(late.filter("line > 1"), path, "trip_month", BATCH_ROWS)
    append_months(late, path, "late", batch_size=BATCH_ROWS)
    append_months(early, path, "early", batch_size=BATCH_ROWS)
    discard(rows)
    if files_over(spark, path, BATCH_ROWS):
        raise ValueError("a file has more rows than its batch allows")
    return read_months(spark, path)


def files_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each file, whether a tenth of it is drawn, and whether the draw is the same however it is read."""
    paths = [f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem")]
    trips = read_trips(spark, paths, file="file_path", row="row_index")
    counts = file_counts(trips, ["file_path", "row_index"], 0.1)
    again = sample_files(trips.repartition(5, "row_index"), 0.1).groupBy("file_path").agg(F.count(F.lit(1)).alias("again"))
    # Six deviations of a binomial share.
    fits = F.abs(F.col("sampled_rows") - 0.1 * F.col("original_rows")) <= 6 * F.sqrt(0.09 * F.col("original_rows"))
    return counts.join(again, "file_path").select(
        "file_name", "original_rows", fits.alias("share_fits"), (F.col("again") == F.col("sampled_rows")).alias("fixed")
    )


def nested_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table with another table in a cell: the first cell, all cells, and the inner table's rows."""
    rows = table_rows(views.nested_pages(spark, sf_dir), ["page_id"], "outer")
    cells = top_elements(F.col("markup"), "t[dh]")
    inner = F.regexp_extract(F.col("markup"), r"(?is)<table[^>]*>(.*)$", 1)
    return rows.select(
        "page_id",
        "position",
        F.size(cells).alias("cells"),
        cell_text(F.get(cells, F.lit(0))).alias("first_cell"),
        cell_text(F.get(cells, F.size(cells) - 1)).alias("last_cell"),
        F.size(top_elements(inner, "tr")).alias("inner_rows"),
    )


def append_twice(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "csv")
    rows = views.weather_rows(spark, sf_dir)
    append_csv(rows, path)
    append_csv(rows.filter(F.col("weather") == "Fog."), path)
    return path


def csv_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_weather(spark, append_twice(spark, sf_dir))


def csv_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_csv(spark, append_twice(spark, sf_dir), WEATHER_SCHEMA)


def first_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(c.trips(spark, sf_dir), ["trip_id"])


def list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = html_rows(views.table(spark, sf_dir, "pages"), ["page_id"], "li")
    return rows.select("page_id", "position", cell_text(F.col("markup")).alias("text"))


def pages_of_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = pages_with_param(views.table(spark, sf_dir, "pages"), "page")
    return pages.select("page_id", "url")


def weather_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day pages to readings to CSV and back."""
    path = scratch_path(spark, "csv")
    append_csv(weather_readings(views.weather_pages(spark, sf_dir)), path)
    return read_weather(spark, path)


def weather_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages in two arrivals; the second start reads only the new ones."""
    pages, csv = scratch_path(spark, "pages"), scratch_path(spark, "csv")
    log = scratch_path(spark, "progress")
    source = views.weather_pages(spark, sf_dir).select(PAGE_SCHEMA.names)
    first = F.col("link_text") < " 2024-01-16"
    for arrived in (first, ~first):
        source.filter(arrived).write.mode("append").parquet(pages)
        stream_weather(spark, pages, csv, log).awaitTermination()
    return read_weather(spark, csv)


WEATHER_SELECT = (
    "SELECT row_index, date, time, temp, weather, wind, humidity, barometer, visibility FROM "
)
INGESTED = c.with_(
    c.WEATHER_HOURS,
    """SELECT date || ' ' || clock AS row_index, date, clock AS time, temp, weather, wind,
       humidity, barometer, visibility
FROM (SELECT *, ((weather_hour + 11) % 12 + 1) || strftime(weather_timestamp, ':%M')
                || CASE WHEN weather_hour < 12 THEN ' am' ELSE ' pm' END AS clock
      FROM weather_hours)""",
)
APPENDED = f"""{WEATHER_SELECT} weather UNION ALL
{WEATHER_SELECT} weather WHERE weather = 'Fog.'"""


def _counts_sql(name: str, keys: list[str]) -> str:
    columns = [k if k in keys else "NULL" for k in COUNT_KEYS]
    return f"""SELECT '{name}.parquet' AS file_name, count(*) AS original_rows,
       count(*) FILTER (WHERE {c.unit_sql(columns)} < 0.1) AS sampled_rows FROM {name}"""


QUERIES = {
    "scan_union_by_name": scan_union_by_name,
    "file_counts": count_files,
    "read_weather_csv": weather_csv,
    "read_zones_csv": zones_csv,
    "read_processed": processed_read,
    "write_read_roundtrip": write_read_roundtrip,
    "append_batches": append_batches,
    "append_months": months_appended,
    "sample_by_file": files_sampled,
    "nested_rows": nested_rows,
    "append_csv": csv_appended,
    "csv_row_count": csv_row_count,
    "preview": first_trips,
    "html_rows": list_items,
    "pages_with_param": pages_of_param,
    "weather_ingest": weather_ingest,
    "weather_stream": weather_stream,
}

ORACLE = {
    "scan_union_by_name": c.with_(c.TRIPS, "SELECT * FROM trips"),
    "file_counts": f"""{_counts_sql('orders', COUNT_KEYS[:1])}
UNION ALL {_counts_sql('lineitem', COUNT_KEYS[1:])}""",
    "read_weather_csv": c.with_(c.WEATHER, f"{WEATHER_SELECT} weather"),
    "read_zones_csv": c.with_(c.ZONES, "SELECT * FROM zones"),
    "read_processed": c.with_(c.PROCESSED, "SELECT * FROM processed"),
    "write_read_roundtrip": c.with_(c.TRIPS, "SELECT * FROM trips"),
    "append_batches": """SELECT o_orderkey, o_totalprice FROM orders UNION ALL
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 200000""",
    "append_months": c.with_(
        c.ORDER_TRIPS,
        "SELECT order_id, line, CAST(month(request_datetime) AS INTEGER) AS trip_month FROM order_trips",
    ),
    "sample_by_file": """SELECT 'orders.parquet' AS file_name, count(*) AS original_rows, true AS share_fits,
       true AS fixed FROM orders
UNION ALL SELECT 'lineitem.parquet', count(*), true, true FROM lineitem""",
    "nested_rows": """SELECT page_id, CAST(0 AS INTEGER) AS position, CAST(2 AS INTEGER) AS cells, 'page' AS first_cell,
       CAST(page_id AS VARCHAR) AS last_cell, CAST(0 AS INTEGER) AS inner_rows FROM pages
UNION ALL SELECT page_id, 1, 3, 'links', 'z' || (page_id % 7), 2 FROM pages
UNION ALL SELECT page_id, 2, 1, 'last', 'last', 0 FROM pages""",
    "append_csv": c.with_(c.WEATHER, APPENDED),
    "csv_row_count": c.with_(c.WEATHER, f"SELECT count(*) AS records FROM ({APPENDED})"),
    "preview": c.with_(c.TRIPS, "SELECT * FROM trips ORDER BY trip_id LIMIT 2"),
    "html_rows": r"""
SELECT page_id, CAST(position AS INTEGER) AS position,
       regexp_replace(regexp_replace(text, '^\s+', ''), '\s+$', '') AS text
FROM (
  SELECT page_id, position,
         replace(replace(replace(replace(replace(replace(
           regexp_replace(regexp_replace(markup, '(?i)<br\s*/?>', chr(10), 'g'), '<[^>]*>', '', 'g'),
           '&nbsp;', ' '), '&quot;', '"'), '&deg;', '°'), '&lt;', '<'), '&gt;', '>'),
           '&amp;', '&') AS text
  FROM (
    SELECT page_id, unnest(range(len(found))) AS position, unnest(found) AS markup
    FROM (SELECT page_id,
                 regexp_extract_all(html, '(?is)<li(?:\s[^>]*)?>(.*?)</li\s*>', 1) AS found
          FROM pages)))""",
    "pages_with_param": "SELECT page_id, url FROM pages WHERE url LIKE '%page=%'",
    "weather_ingest": INGESTED,
    "weather_stream": INGESTED,
}
