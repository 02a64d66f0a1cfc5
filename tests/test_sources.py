"""Readers, writers, pages and the weather ingest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from waitspark.plans.weather import load_weather, weather_readings
from waitspark.schema import PAGE_SCHEMA, TRIP_SCHEMA, WEATHER_COLUMNS, WEATHER_SCHEMA
from waitspark.sources import (
    append_csv,
    append_in_batches,
    count_csv,
    file_counts,
    html_rows,
    pages_with_param,
    preview,
    read_processed,
    read_trips,
    read_weather,
    write_processed,
)
from waitspark.streaming import stream_weather


def trip_rows(spark, n, first=0):
    start = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(start, start + dt.timedelta(minutes=i), first + i, 1) for i in range(n)], TRIP_SCHEMA
    )


def test_trips_are_matched_by_name(spark, tmp_path):
    path = str(tmp_path / "trips")
    trip_rows(spark, 5).write.parquet(path)
    other = trip_rows(spark, 3, 100).select(*reversed(TRIP_SCHEMA.names))
    other.withColumn("extra", F.lit("x")).write.mode("append").parquet(path)
    (tmp_path / "trips" / "notes.txt").write_text("no trips")
    for schema in (None, TRIP_SCHEMA):
        rows = read_trips(spark, path, schema)
        assert rows.count() == 8
        assert rows.agg(F.sum("PULocationID")).first()[0] == 10 + 303
    assert "extra" in read_trips(spark, path).columns


def test_file_counts(spark, tmp_path):
    for name, n in (("jan", 30), ("feb", 50)):
        trip_rows(spark, n).coalesce(1).write.parquet(str(tmp_path / name))
    trips = read_trips(spark, [str(tmp_path / "jan"), str(tmp_path / "feb")], TRIP_SCHEMA, file="file_path")
    counts = file_counts(trips, ["PULocationID"]).collect()
    assert sorted(r["original_rows"] for r in counts) == [30, 50]
    assert all(r["original_rows"] == r["sampled_rows"] for r in counts)
    half = file_counts(trips, ["PULocationID"], 0.5).collect()
    assert all(0 < r["sampled_rows"] < r["original_rows"] for r in half)


def test_csv_keeps_quotes_spaces_and_gaps(spark, tmp_path):
    path = str(tmp_path / "weather")
    values = ("2024-01-01 0:51", "2024-01-01", "0:51", " -3 °F", "a, b", "", None, '30.05 "Hg', "1")
    rows = spark.createDataFrame([values], WEATHER_SCHEMA)
    append_csv(rows, path)
    # CSV knows no empty text: like a gap it comes back as null.
    expected = tuple(v or None for v in values)
    assert tuple(read_weather(spark, path).first()) == expected
    append_csv(rows, path)
    assert count_csv(spark, path, WEATHER_SCHEMA).first()["records"] == 2


def test_batches_lose_no_row(spark, tmp_path):
    path = str(tmp_path / "batches")
    append_in_batches(spark.range(1000).repartition(4), path, batch_size=100)
    append_in_batches(spark.range(1000, 1010), path, batch_size=100)
    back = spark.read.parquet(path)
    assert back.count() == 1010 and back.distinct().count() == 1010
    sizes = back.groupBy(F.input_file_name()).count().toPandas()["count"]
    assert sizes.max() <= 100


def test_overwrite_and_partitions(spark, tmp_path):
    path = str(tmp_path / "processed")
    df = spark.range(10).withColumn("trip_month", (F.col("id") % 2).cast("int"))
    write_processed(df, path)
    write_processed(df.limit(4), path, ["trip_month"])
    assert read_processed(spark, path).count() == 4
    assert read_processed(spark, path, fraction=1.0).count() == 4


def test_preview(spark):
    assert [r["id"] for r in preview(spark.range(9).repartition(4), ["id"]).collect()] == [0, 1]


def test_html_rows(spark):
    html = "<tr class='x'><td>1</td></tr><track/><TR><td>2\n</td></TR >"
    pages = spark.createDataFrame([(1, html), (2, "none"), (3, None)], "id int, html string")
    rows = html_rows(pages, ["id"]).orderBy("position").collect()
    assert [(r["id"], r["position"]) for r in rows] == [(1, 0), (1, 1)]
    assert rows[1]["markup"] == "<td>2\n</td>"


def test_pages_with_param(spark):
    urls = ["http://x?hd=1", "http://x?a=1", None, "http://x y?hd="]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    assert pages_with_param(pages, "hd").count() == 2


def cells(*texts):
    return "".join(f"<td> {t} </td>" for t in texts)


FULL = ("", "-3&nbsp;°F", "Fog.", "No wind", "<i>up</i>", "61%", "30.05 &quot;Hg", "10&nbsp;mi")
BODY = "".join(
    [
        f"<tr><th>Time</th>{cells(*FULL)}</tr>",
        f"<tr><th scope=row>12:51 am<br>Mon, Jan 1</th>{cells(*FULL)}</tr>",
        f"<tr><th>1:51 am</th>{cells(*FULL[:7])}</tr>",
        f"<tr><td>no heading</td>{cells(*FULL)}</tr>",
        f"<tr><th></th>{cells(*FULL)}</tr>",
        f"<tr><th>2:51 am</th>{cells('', '', *FULL[2:])}</tr>",
        f"<tr><th>1:05 pm</th>{cells(*FULL)}</tr>",
    ]
)
PAGE = f"""<table id=other><tbody><tr><th>9:00 am</th></tr></tbody></table>
<table class='a' id="wt-his"><thead><tr><th>x</th></tr></thead><tbody>{BODY}</tbody></table>"""


def page_rows(spark, *days):
    rows = [(f"http://w/h?month=1&hd={d}", " Jan 1 ", PAGE) for d in days]
    rows.append(("http://w/h?month=1", "month", PAGE))
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def test_readings_of_a_page(spark):
    rows = weather_readings(page_rows(spark, "20240101", "bad")).collect()
    got = sorted(tuple(r) for r in rows)
    measures = ("-3 °F", "Fog.", "No wind", "61%", '30.05 "Hg', "10 mi")
    assert got == sorted(
        (f"{day} {time}", day, time, *measures)
        for day in ("2024-01-01", "Jan 1")
        for time in ("12:51 am", "1:05 pm")
    )


def test_load_weather_appends(spark, tmp_path):
    path = str(tmp_path / "csv")
    load_weather(page_rows(spark, "20240101"), path)
    load_weather(page_rows(spark, "20240102"), path, keep_meridiem=False)
    back = read_weather(spark, path)
    assert back.columns == WEATHER_COLUMNS
    assert {r["row_index"] for r in back.collect()} == {
        "2024-01-01 12:51 am", "2024-01-01 1:05 pm", "2024-01-02 12:51", "2024-01-02 1:05",
    }


def test_stream_appends_each_page_once(spark, tmp_path):
    pages, csv, log = (str(tmp_path / n) for n in ("pages", "csv", "log"))
    for day in ("20240101", "20240102"):
        page_rows(spark, day).write.mode("append").parquet(pages)
        stream_weather(spark, pages, csv, log).awaitTermination()
        stream_weather(spark, pages, csv, log).awaitTermination()
    days = [r["date"] for r in read_weather(spark, csv).collect()]
    assert sorted(days) == ["2024-01-01"] * 2 + ["2024-01-02"] * 2


def test_trips_lose_no_entry_and_widen(spark, tmp_path):
    folder = tmp_path / "months"
    folder.mkdir()
    frame = spark.range(5).selectExpr("CAST(id AS INT) AS PULocationID", "'a' AS note").toPandas()
    frame.astype({"PULocationID": "int32"}).to_parquet(folder / "jan.parquet")
    spark.range(7).selectExpr("id AS PULocationID", "id % 2 AS part").write.partitionBy("part").parquet(str(folder / "feb.parquet"))
    rows = read_trips(spark, str(folder))
    assert rows.count() == 12
    assert dict(rows.dtypes)["PULocationID"] == "bigint"
    assert rows.filter("part IS NULL").count() == 5 and rows.filter("note IS NULL").count() == 7


def test_files_of_one_name_are_counted_apart(spark, tmp_path):
    for month, n in ((1, 10), (2, 20)):
        (tmp_path / f"month={month}").mkdir()
        spark.range(n).toPandas().to_parquet(tmp_path / f"month={month}" / "data.parquet")
    rows = read_trips(spark, [str(tmp_path / f"month={m}" / "data.parquet") for m in (1, 2)], file="file_path")
    counts = file_counts(rows, ["id"]).collect()
    assert sorted(r["original_rows"] for r in counts) == [10, 20]
    assert {r["file_name"] for r in counts} == {"data.parquet"}


def test_line_breaks_do_not_split_records(spark, tmp_path):
    rows = [tuple("Light rain.\nFog." if c == "weather" else "x" for c in WEATHER_SCHEMA.names)]
    append_csv(spark.createDataFrame(rows, WEATHER_SCHEMA), str(tmp_path / "csv"))
    got = read_weather(spark, str(tmp_path / "csv")).collect()
    assert [r["weather"] for r in got] == ["Light rain. Fog."]
