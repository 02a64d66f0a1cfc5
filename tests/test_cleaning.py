"""Filters, their reports, encoding, joins and views on literal rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waitspark.operators.cleaning import (
    dedupe_hourly,
    drop_null_keys,
    drop_time_anomalies,
    keep_day_kind,
    keep_non_negative,
    null_key_report,
    time_anomaly_report,
    unmatched_count,
    valid_readings,
)
from waitspark.operators.encoding import apply_codes, category_codes, encode_category
from waitspark.operators.joins import join_weather, join_zones, zone_map
from waitspark.operators.sampling import hash_sample, sample
from waitspark.sources import read_zones
from waitspark.views import with_next_time
from waitspark.workspace import collect_small, materialize, scratch_root


def at(minute: int) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


TIMES = "request_datetime timestamp_ntz, on_scene_datetime timestamp_ntz"


def test_time_anomalies(spark):
    rows = [(at(0), at(5)), (at(5), at(5)), (at(6), at(5)), (at(0), None), (None, at(1))]
    df = spark.createDataFrame(rows, TIMES)
    assert drop_time_anomalies(df).count() == 2
    assert time_anomaly_report(df).first().asDict() == {
        "total_rows": 5, "anomaly_rows": 3, "anomaly_percent": 60.0, "kept_rows": 2,
    }
    assert time_anomaly_report(df.limit(0)).first()["anomaly_percent"] == 0.0


def test_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    assert drop_null_keys(df, ["k", "v"]).count() == 1
    assert tuple(null_key_report(df, ["k", "v"]).first()) == (3, 1, 2)
    assert tuple(null_key_report(df, ["k"]).first()) == (3, 2, 1)
    floats = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert drop_null_keys(floats, ["v"]).count() == floats.dropna().count() == 1


def test_dedupe_keeps_the_earliest_and_breaks_ties(spark):
    rows = [
        (at(20), dt.date(2024, 1, 1), 0, "b"),
        (at(10), dt.date(2024, 1, 1), 0, "z"),
        (at(10), dt.date(2024, 1, 1), 0, "y"),
        (at(70), dt.date(2024, 1, 1), 1, None),
        (None, None, None, "lost"),
    ]
    df = spark.createDataFrame(
        rows, "weather_timestamp timestamp_ntz, weather_date date, weather_hour int, w string"
    )
    for n in (1, 4, 7):
        got = dedupe_hourly(df.repartition(n))
        assert got.columns == df.columns
        assert {r["w"] for r in got.collect()} == {"y", None, "lost"}


def test_small_filters(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,), (0.0,)], "v double")
    assert keep_non_negative(df, "v").count() == 2
    readings = spark.createDataFrame(
        [("1:00", "3"), ("", "3"), ("1:00", None), ("1:00", "")], "time string, temp string"
    )
    assert valid_readings(readings).count() == 1
    days = spark.createDataFrame([(0,), (1,), (1,)], "is_weekend int")
    assert keep_day_kind(days, weekend=True).count() == 2


def test_unmatched_counts_null_once(spark):
    facts = spark.createDataFrame([(1,), (9,), (9,), (None,), (None,)], "k int")
    dim = spark.createDataFrame([(1,)], "id int")
    assert unmatched_count(facts, "k", dim, "id").first()[0] == 2


def test_samples(spark):
    df = spark.range(10_000)
    assert sample(df, None).count() == sample(df, 1.0).count() == sample(df, 0).count() == 10_000
    assert sample(df, 0.1).count() == pytest.approx(1000, abs=150)
    assert hash_sample(df, ["id"], 0.1).count() == pytest.approx(1000, abs=150)
    assert hash_sample(df, ["id"], 2).count() == 10_000


CATEGORIES = ["Fog.", "Clear.", None, "Clear.", "Rain", "A", "B", "C"]


@pytest.mark.parametrize("limit", [0, 10_000])
def test_codes_are_alphabetical_and_dense(spark, limit):
    df = spark.createDataFrame([(v,) for v in CATEGORIES], "v string")
    codes = category_codes(df, "v", local_limit=limit)
    expected = {v: i + 1 for i, v in enumerate(sorted({v for v in CATEGORIES if v}))}
    assert {r["v"]: r["code"] for r in codes.collect()} == expected
    coded = apply_codes(df, codes, "v", "code_of_v")
    assert {r["v"]: r["code_of_v"] for r in coded.collect()} == {**expected, None: 0}
    assert coded.count() == len(CATEGORIES)


def test_many_codes_over_many_tasks(spark):
    df = spark.range(5000).select(F.format_string("v%05d", "id").alias("v")).repartition(7)
    codes = category_codes(df, "v", local_limit=100).collect()
    assert sorted((r["v"], r["code"]) for r in codes) == [
        (f"v{i:05d}", i + 1) for i in range(5000)
    ]


def test_codes_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v string")
    coded, codes = encode_category(df, "v", "c")
    assert codes.count() == 0
    assert coded.first()["c"] == 0


ZONE_LINES = '''"LocationID","Borough","Zone","service_zone"
56,"Queens","Corona","Boro Zone"
57,"Queens","Corona","Boro Zone"
264,"Unknown","N/A","N/A"
265,"N/A","Outside of NYC","N/A"
'''


@pytest.fixture()
def zones(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(ZONE_LINES)
    return read_zones(spark, str(path))


def test_not_available_zones_are_text(zones):
    rows = {r["LocationID"]: r for r in zones.collect()}
    assert rows[264]["Zone"] == "N/A" and rows[265]["Borough"] == "N/A"


def test_joins_keep_every_trip(spark, zones):
    trips = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 0, 56, 264), (dt.date(2024, 1, 1), 1, 999, None)],
        "request_date date, request_hour int, PULocationID int, DOLocationID int",
    )
    weather = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 0, "Fog."), (None, None, "lost")],
        "weather_date date, weather_hour int, weather string",
    )
    rows = join_zones(join_weather(trips, weather), zones).orderBy("request_hour").collect()
    assert len(rows) == 2
    assert rows[0]["weather"] == "Fog." and rows[0]["DOLocationZone"] == "N/A"
    assert rows[1]["weather"] is None and rows[1]["PUBorough"] is None


def test_zone_map_pairs_equal_names(spark):
    shapes = spark.createDataFrame([(1, "Corona"), (2, "Corona"), (3, "X")], "id int, zone string")
    means = spark.createDataFrame(
        [("Corona", 2.0), ("Corona", 3.0)], "PULocationZone string, avg_wait_minutes double"
    )
    rows = zone_map(shapes, means).collect()
    assert len(rows) == 5
    assert [r["avg_wait_minutes"] for r in rows if r["id"] == 3] == [0.0]


def test_next_time_equals_a_plain_window(spark):
    """A hot key with ties, many rows to a minute and empty minutes between."""
    df = spark.range(4000).select(
        F.col("id").alias("event"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("user"),
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0, (id * 7919 % 1000) * 13)").alias("ts"),
    )
    got = with_next_time(df, "user", "ts", "next")
    plain = df.withColumn("next", F.lead("ts").over(Window.partitionBy("user").orderBy("ts")))
    columns = ["user", "ts", "next"]

    def rows(d):
        return sorted(d.select(columns).collect(), key=repr)

    assert rows(got) == rows(plain)


def test_collect_small_refuses(spark):
    assert len(collect_small(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        collect_small(spark.range(6), 5)


def test_materialize_survives_in_the_shared_folder(spark):
    df = materialize(spark.range(10).withColumn("p", F.col("id") % 2), "test", ["p"])
    assert df.count() == 10
    assert scratch_root(spark).split(":")[-1].rstrip("/") in df.inputFiles()[0]
