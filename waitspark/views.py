"""Trips, weather, zones and pages as views over the given tables.

The wait analysis needs trip and weather tables; these views derive them from the tables at hand,
so that all work grows with those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from waitspark.operators.cleaning import dedupe_hourly
from waitspark.schema import WEATHER_COLUMNS

# The weather kinds by the event number's remainder, and the shape of a day page.
WEATHER_KINDS = ["Clear.", "Fog.", "Overcast.", "Light rain."]
PAGE_URL = "https://weather.example.com/historic?month=1&hd="
PAGE_HEAD = '<html><table id="wt-his"><tbody><tr><th>Time</th><td>Temp</td></tr>'
PAGE_TAIL = "</tbody></table></html>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_number() -> Column:
    """The integer k of an event's properties."""
    return F.get_json_object("props", "$.k").cast("int")


def with_next_time(df: DataFrame, key: str, time: str, output: str) -> DataFrame:
    """Adds the time of the key's next row.

    A key may hold a large part of all rows, so rows are ordered within one minute of a key at a
    time; the last row of a minute takes the first time of the key's next minute that has any.
    """
    minute = F.expr(f"unix_timestamp({time}) div 60")
    slots = df.withColumn("slot", minute)
    heads = slots.groupBy(key, "slot").agg(F.min(time).alias("head"))
    by_key = Window.partitionBy(key).orderBy("slot")
    heads = heads.select(key, "slot", F.lead("head").over(by_key).alias("next_head"))
    by_slot = Window.partitionBy(key, "slot").orderBy(time)
    inner = slots.withColumn("next_inner", F.lead(time).over(by_slot))
    joined = inner.join(heads, [key, "slot"], "left")
    joined = joined.withColumn(output, F.coalesce("next_inner", "next_head"))
    return joined.drop("slot", "next_inner", "next_head")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event of a user but a signup is a request, answered at the user's next one."""
    events = table(spark, sf_dir, "events").filter(F.col("event_type") != "signup")
    requests = events.select(
        F.col("event_id").alias("trip_id"),
        "user_id",
        F.col("ts").alias("request_datetime"),
        (event_number() % 30).alias("DOLocationID"),
    )
    requests = with_next_time(requests, "user_id", "request_datetime", "on_scene_datetime")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("PULocationID")
    )
    return requests.join(customers, "user_id").select(
        "trip_id", "request_datetime", "on_scene_datetime", "PULocationID", "DOLocationID"
    )


def order_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order to shipment of each line as a trip; spans years and holds many reversed pairs."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("on_scene_datetime"),
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("request_datetime")
    )
    return lines.join(orders, "order_id").select(
        "order_id", "line", "request_datetime", "on_scene_datetime"
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signup events as weather readings, several in some hours and none in others."""
    k = event_number()
    kind = F.get(F.array(*[F.lit(w) for w in WEATHER_KINDS]), k % 4)
    speed = F.concat((k % 30).cast("string"), F.lit(" mph"))
    wind = F.when(k % 10 == 0, "No wind").otherwise(speed)
    day = F.to_date("ts")
    clock = F.concat(
        F.hour("ts").cast("string"), F.lit(":"), F.lpad(F.minute("ts").cast("string"), 2, "0")
    )
    events = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    readings = events.select(
        F.col("event_id").alias("reading_id"),
        F.col("ts").alias("weather_timestamp"),
        day.alias("weather_date"),
        F.hour("ts").alias("weather_hour"),
        day.cast("string").alias("date"),
        clock.alias("time"),
        F.concat(k.cast("string"), F.lit(" °F")).alias("temp"),
        kind.alias("weather"),
        wind.alias("wind"),
        F.concat(k.cast("string"), F.lit("%")).alias("humidity"),
        F.concat(F.lit("30."), k.cast("string"), F.lit(' "Hg')).alias("barometer"),
        F.concat((k % 10).cast("string"), F.lit(" mi")).alias("visibility"),
    )
    return readings.withColumn("row_index", F.concat_ws(" ", "date", "time"))


def weather_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings in the columns of the weather CSV."""
    return weather(spark, sf_dir).select(WEATHER_COLUMNS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    joined = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    return joined.select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.concat(F.lit("Service "), F.col("n_regionkey").cast("string")).alias("service_zone"),
    )


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shape names, some of them twice."""
    number = (F.col("n_nationkey") % 20).cast("string")
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("shape_id"), F.concat(F.lit("NATION_"), number).alias("zone")
    )


def half_day_clock() -> Column:
    """The reading's time as "h:mm am"."""
    hour = (F.col("weather_hour") + 11) % 12 + 1
    half = F.when(F.col("weather_hour") < 12, " am").otherwise(" pm")
    minute = F.lpad(F.minute("weather_timestamp").cast("string"), 2, "0")
    return F.concat(hour.cast("string"), F.lit(":"), minute, half)


def weather_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One page per day with a row for each hour that has a reading: at most 24 rows a page.

    Cells write the degree sign as an entity and one weather text over two lines. Every seventh day's link lacks the date, which its text then gives.
    """
    hours = dedupe_hourly(weather(spark, sf_dir))
    cells = ["", "temp", "weather", "wind", "", "humidity", "barometer", "visibility"]
    row = [F.lit("<tr><th>"), half_day_clock(), F.lit("<br>"), F.col("date"), F.lit("</th>")]
    for name in cells:
        text = F.replace(F.col(name), F.lit('"'), F.lit("&quot;")) if name else F.lit("<i></i>")
        text = F.replace(text, F.lit("°"), F.lit("&#176;"))
        text = F.replace(text, F.lit("Light rain."), F.lit("Light<br>rain."))
        row += [F.lit("<td> "), text, F.lit("</td>")]
    row.append(F.lit("</tr>\n"))
    listed = F.sort_array(F.collect_list(F.struct("weather_hour", F.concat(*row).alias("row"))))
    days = hours.groupBy("date").agg(listed.alias("rows"))
    undated = F.dayofmonth(F.to_date("date")) % 7 == 0
    link = F.when(undated, "0").otherwise(F.replace(F.col("date"), F.lit("-"), F.lit("")))
    body = F.array_join(F.transform("rows", lambda r: r["row"]), "")
    return days.select(
        F.concat(F.lit(PAGE_URL), link).alias("url"),
        F.concat(F.lit(" "), F.col("date"), F.lit(" ")).alias("link_text"),
        F.concat(F.lit(PAGE_HEAD), body, F.lit(PAGE_TAIL)).alias("html"),
    )


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a table whose second row holds another table in a cell, and an unclosed third row."""
    number = F.col("page_id").cast("string")
    parts = [
        F.lit('<p>before</p><TABLE class="x" id="outer"><tbody><tr><th>page</th><td>'), number,
        F.lit('</td></tr><tr class="r"><td>links</td><td><table><tr><td>'), F.col("url"),
        F.lit("</td></tr><tr><td>x</td></tr></table></td><td>z"), (F.col("page_id") % 7).cast("string"),
        F.lit("</td></tr><tr><td>last</td></tbody></TABLE><table><tr><td>after</td></tr></table>"),
    ]
    return table(spark, sf_dir, "pages").select("page_id", F.concat(*parts).alias("html"))
