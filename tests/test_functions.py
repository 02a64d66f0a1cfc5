"""Column functions on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from waitspark.functions import (
    SIGNED_DECIMAL,
    cell_text,
    clean_time,
    extract_number,
    hash_unit,
    merge_datetime,
    trip_calendar,
    url_param,
    url_param_date,
    wait_minutes,
    weather_time_parts,
    zone_label,
)


def texts(spark, values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "i int, t string").coalesce(1)


def applied(spark, values, function):
    rows = texts(spark, values).select("i", function(F.col("t")).alias("r"))
    return [r["r"] for r in rows.orderBy("i").collect()]


def test_extract_number_takes_the_first_digits(spark):
    values = ["-3 °F", '30.05 "Hg', "No wind", "7 mph", "61%", None, ""]
    assert applied(spark, values, extract_number) == [3, 30, None, 7, 61, None, None]


def test_extract_number_signed_and_with_default(spark):
    values = ["-3 °F", '30.05 "Hg', "No wind", None]
    got = applied(spark, values, lambda t: extract_number(t, SIGNED_DECIMAL, "double", 0))
    assert got == [-3.0, 30.05, 0.0, None]


def test_extract_number_too_large_is_null(spark):
    assert applied(spark, ["99999999999"], extract_number) == [None]


def test_clean_time(spark):
    values = ["12:51 am\nMon, Jan 1", " 0:51\n", "1:05 PM", "13:51:22", "", None, "n/a", " 7:00"]
    assert applied(spark, values, clean_time) == [
        "12:51 am", "0:51", "1:05 PM", "13:51", "", "", "n/a", "7:00",
    ]
    got = applied(spark, values, lambda t: clean_time(t, keep_meridiem=False))
    assert got == ["12:51", "0:51", "1:05", "13:51", "", "", "n/a", "7:00"]


def test_merge_datetime(spark):
    rows = [("2024-01-01", "0:51"), ("", "0:51"), ("2024-01-01", ""), (None, "1:00")]
    df = spark.createDataFrame(rows, "d string, t string").coalesce(1)
    got = [r[0] for r in df.select(merge_datetime(F.col("d"), F.col("t"))).collect()]
    assert got == ["2024-01-01 0:51", "", "", ""]


def test_url_param(spark):
    urls = {
        "http://x/y?hd=20240131&z=1": "20240131",
        "http://x/y?a=1&hd=20240131#hd=9": "20240131",
        "http://x/y?xhd=20240131": "",
        "http://x/y#?hd=20240131": "",
        "http://x/y z|?hd=1": "1",
        "http://x/y?hd=": "",
        "http://x/y?a=b?c&hd=7": "7",
        "hd=20240131": "",
    }
    assert applied(spark, urls, lambda u: url_param(u, "hd")) == list(urls.values())


def test_url_param_date(spark):
    rows = [("http://x?hd=20240131", "Jan 31"), ("http://x?hd=202401", " Jan 31 "), (None, "Jan")]
    df = spark.createDataFrame(rows, "u string, t string").coalesce(1)
    got = [r[0] for r in df.select(url_param_date(F.col("u"), F.col("t"))).collect()]
    assert got == ["2024-01-31", "Jan 31", "Jan"]


def test_weather_time_parts(spark):
    values = ["2024-01-01 0:51", "2024-01-01 12:51 am", "2024-07-01 1:05 PM", "13:51", "", None]
    df = texts(spark, values).withColumnRenamed("t", "row_index")
    rows = weather_time_parts(df).orderBy("i").collect()
    assert [r["weather_timestamp"] for r in rows] == [
        dt.datetime(2024, 1, 1, 0, 51),
        dt.datetime(2024, 1, 1, 0, 51),
        dt.datetime(2024, 7, 1, 13, 5),
        None,
        None,
        None,
    ]
    assert [r["weather_hour"] for r in rows] == [0, 0, 13, None, None, None]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The night New York's clocks skip 2:30.
        df = spark.sql(
            "SELECT timestamp_ntz'2024-03-10 02:30:00.9' AS request_datetime,"
            " timestamp_ntz'2024-03-10 03:30:00.1' AS on_scene_datetime,"
            " '2024-03-10 2:30' AS row_index"
        )
        row = weather_time_parts(df).select("*", wait_minutes().alias("w")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row["w"] == 60.0
    assert row["weather_hour"] == 2


def test_wait_rounds_half_up_after_cutting_seconds(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 00:00:00.9' AS request_datetime,"
        " timestamp_ntz'2024-01-01 00:00:15.0' AS on_scene_datetime"
    )
    assert df.select(wait_minutes()).first()[0] == 0.3


def test_calendar(spark):
    df = spark.sql(
        "SELECT explode(sequence(date'2024-01-06', date'2024-01-08')) AS request_datetime"
    )
    rows = trip_calendar(df).orderBy("request_datetime").collect()
    assert [(r["weekday"], r["is_weekend"], r["trip_month"]) for r in rows] == [
        (7, 1, 1), (1, 1, 1), (2, 0, 1),
    ]


def test_cell_text(spark):
    values = [" 12:51 am<br/>Mon", "<b>7</b> &deg;F ", "30 &quot;Hg", "&amp;lt;", "<i></i>"]
    assert applied(spark, values, cell_text) == ["12:51 am\nMon", "7 °F", '30 "Hg', "&lt;", ""]


def test_zone_label(spark):
    df = spark.createDataFrame([("Queens", "Astoria")], "b string, z string")
    assert df.select(zone_label(F.col("b"), F.col("z"))).first()[0] == "(Queens) Astoria"


def test_hash_unit_is_spread_and_fixed(spark):
    df = spark.range(20_000)
    row = df.select(hash_unit(["id"]).alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= row[0] and row[1] < 1 and row[2] == pytest.approx(0.5, abs=0.02)
    parts = {
        n: sorted(df.repartition(n).filter(hash_unit(["id"]) < 0.01).toPandas()["id"])
        for n in (1, 4, 7)
    }
    assert parts[1] == parts[4] == parts[7]
