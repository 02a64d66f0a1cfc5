"""Appending weather day pages to the CSV as they arrive."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from waitspark.plans.weather import weather_readings
from waitspark.schema import PAGE_SCHEMA
from waitspark.sources.tables import CSV_OPTIONS, one_line


def stream_weather(
    spark: SparkSession,
    pages_path: str,
    csv_path: str,
    checkpoint_path: str,
    keep_meridiem: bool = True,
) -> StreamingQuery:
    """Reads the Parquet day pages not yet seen, appends their readings, and ends.

    The checkpoint remembers the files read, so each page is appended once, also after a restart.
    The readings need no state: each page stands alone.
    """
    pages = spark.readStream.schema(PAGE_SCHEMA).parquet(pages_path)
    writer = one_line(weather_readings(pages, keep_meridiem)).writeStream.format("csv")
    writer = writer.options(**CSV_OPTIONS, checkpointLocation=checkpoint_path)
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer = writer.option("ignoreTrailingWhiteSpace", False)
    return writer.outputMode("append").trigger(availableNow=True).start(csv_path)
