"""From day pages of hourly weather to the weather CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.functions.text import cell_text, clean_time, merge_datetime, url_param_date
from waitspark.operators.cleaning import valid_readings
from waitspark.schema import WEATHER_COLUMNS
from waitspark.sources.pages import (
    element_pattern,
    html_rows,
    html_table,
    pages_with_param,
    row_cells,
)
from waitspark.sources.tables import append_csv

# Parameter of a day link, id of the table, its header, and the cell of each measure.
DAY_PARAM = "hd"
TABLE_ID = "wt-his"
TIME_HEADER = "Time"
MIN_CELLS = 8
MEASURE_CELLS = {
    "temp": 1,
    "weather": 2,
    "wind": 3,
    "humidity": 5,
    "barometer": 6,
    "visibility": 7,
}


def weather_readings(pages: DataFrame, keep_meridiem: bool = True) -> DataFrame:
    """One row per hourly reading of (url, link_text, html) day pages, in the CSV's columns."""
    days = pages_with_param(pages, DAY_PARAM).select(
        url_param_date(F.col("url"), F.col("link_text"), DAY_PARAM).alias("date"),
        html_table(F.col("html"), TABLE_ID).alias("body"),
    )
    rows = html_rows(days, ["date"], "tr", "body")
    heading = F.regexp_extract(F.col("markup"), element_pattern("th"), 1)
    parsed = rows.select(
        "date",
        F.rlike(F.col("markup"), F.lit(element_pattern("th"))).alias("headed"),
        cell_text(heading).alias("heading"),
        row_cells(F.col("markup")).alias("cells"),
    ).filter(F.col("headed") & (F.col("heading") != TIME_HEADER))
    whole = F.size("cells") >= MIN_CELLS
    measures = {
        name: F.when(whole, F.get("cells", F.lit(i))) for name, i in MEASURE_CELLS.items()
    }
    readings = parsed.withColumn("time", clean_time(F.col("heading"), keep_meridiem))
    readings = valid_readings(readings.withColumns(measures))
    row_index = merge_datetime(F.col("date"), F.col("time"))
    return readings.withColumn("row_index", row_index).select(WEATHER_COLUMNS)


def load_weather(pages: DataFrame, path: str, keep_meridiem: bool = True) -> None:
    """Appends the readings of day pages to the weather CSV folder."""
    append_csv(weather_readings(pages, keep_meridiem), path)
