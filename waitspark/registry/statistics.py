"""Queries over aggregates, distributions and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark import views
from waitspark.functions.times import trip_calendar, wait_minutes
from waitspark.operators.aggregates import (
    describe,
    hourly_series,
    mean_wait_by_hour,
    mean_wait_by_month,
    mean_wait_by_zone,
    top_zones,
)
from waitspark.operators.cleaning import drop_time_anomalies
from waitspark.operators.distributions import (
    BINS,
    DENSITY_POINTS,
    PER_BANDWIDTH,
    correlation_matrix,
    density_curve,
    histogram,
)
from waitspark.operators.metrics import compare_models, regression_metrics, with_residual
from waitspark.operators.quantiles import QUARTILES, exact_quantiles
from waitspark.operators.sketches import sketched_quantiles, update_sketches
from waitspark.plans.charts import chart_summary
from waitspark.registry import common as c
from waitspark.schema import FEATURES, HISTOGRAM_FEATURES, TARGET
from waitspark.workspace import collect_small, materialize, scratch_path

RANK_ERROR = 0.01
MEAN_MODELS = ["hour_mean", "zone_mean"]


def quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem")
    rows, found = exact_quantiles(lines, "l_extendedprice", (0.25, 0.5, 0.75))
    values = [(rows, *(found or [None] * 3))]
    return spark.createDataFrame(values, "n long, p25 double, p50 double, p75 double")


def by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_wait_by_zone(c.processed(spark, sf_dir))
    return means.select("PULocationZone", "PUBorough", c.rounded("avg_wait_minutes"))


def collected_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that ``collect_small`` brings to the driver, as a table again."""
    months = views.order_trips(spark, sf_dir).groupBy(F.month("request_datetime").alias("trip_month"))
    found = collect_small(months.agg(F.count(F.lit(1)).alias("n")), 12)
    rows = [(int(m), int(n)) for m, n in found.itertuples(index=False)]
    return spark.createDataFrame(rows, "trip_month int, n long")


def by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = trip_calendar(drop_time_anomalies(views.order_trips(spark, sf_dir)))
    means = mean_wait_by_month(trips.withColumn(TARGET, wait_minutes()))
    return means.select("trip_month", c.rounded("avg_wait"))


def by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = mean_wait_by_hour(c.processed(spark, sf_dir))
    return means.select("request_hour", "is_weekend", c.rounded("avg_wait_minutes"))


def by_hour_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = hourly_series(c.processed(spark, sf_dir))
    return series.select("request_hour", c.rounded("weekday_wait"), c.rounded("weekend_wait"))


def longest_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = top_zones(c.processed(spark, sf_dir))
    return top.select("PULocationZone", "PUBorough", c.rounded("avg_wait_minutes"), "formatted_zone")


def feature_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = histogram(c.processed(spark, sf_dir), [*HISTOGRAM_FEATURES, TARGET])
    edges = [c.rounded("lower_edge"), c.rounded("upper_edge")]
    return bins.select("feature", "bin", *edges, "frequency")


def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = correlation_matrix(c.processed(spark, sf_dir), [*FEATURES, TARGET])
    return matrix.select("row_name", "column_name", c.rounded("r"))


def describe_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = describe(c.processed(spark, sf_dir))
    names = [n for n in summary.columns if n != "count"]
    return summary.select("count", *[c.rounded(n) for n in names])


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounded residuals of each of the two models."""
    rows = with_residual(c.mean_predictions(spark, sf_dir))
    return rows.select("model", c.rounded("residual"))


def error_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(errors(spark, sf_dir), "errors")
    edges = [c.rounded("lower_edge"), c.rounded("upper_edge")]
    parts = [
        histogram(rows.filter(F.col("model") == m), ["residual"]).select(F.lit(m).alias("model"), "bin", *edges, "frequency")
        for m in MEAN_MODELS
    ]
    return parts[0].unionByName(parts[1])


def error_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(errors(spark, sf_dir), "errors")
    parts = [
        density_curve(rows.filter(F.col("model") == m), "residual").select(
            F.lit(m).alias("model"), "point", c.rounded("x"), c.rounded("density", 12)
        )
        for m in MEAN_MODELS
    ]
    return parts[0].unionByName(parts[1])


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = regression_metrics(c.mean_predictions(spark, sf_dir), "model")
    names = ("mse", "rmse", "mae", "r2")
    return found.select("model", "n", *[c.rounded(n) for n in names])


def comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_models(c.mean_predictions(spark, sf_dir), MEAN_MODELS)


def histogram_sql(source: str, column: str) -> str:
    """(feature, bin, lower_edge, upper_edge, frequency) by the edges alone, without division."""
    return f"""
SELECT '{column}' AS feature, CAST(b.bin AS INTEGER) AS bin,
       round(b.low, 6) AS lower_edge, round(b.high, 6) AS upper_edge,
       (SELECT count(*) FROM {source}
        WHERE {column} >= b.low AND ({column} < b.high OR (b.bin = {BINS - 1}
                                                           AND {column} <= b.high))) AS frequency
FROM (
  SELECT bin, low + bin * ((high - low) / {BINS}) AS low,
         CASE WHEN bin = {BINS - 1} THEN high ELSE low + (bin + 1) * ((high - low) / {BINS}) END
           AS high
  FROM (
    SELECT CASE WHEN lo = hi THEN lo - 0.5::DOUBLE ELSE lo END AS low,
           CASE WHEN lo = hi THEN hi + 0.5::DOUBLE ELSE hi END AS high
    FROM (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi
          FROM {source})) e, range({BINS}) t(bin)) b"""


def correlation_sql(columns: list[str]) -> str:
    rows = []
    for a in columns:
        for b in columns:
            r = f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END"
            rows.append(
                f"SELECT '{a}' AS row_name, '{b}' AS column_name, round({r}, 6) AS r FROM processed"
            )
    return "\nUNION ALL ".join(rows)


ERRORS = c.PREDICTIONS + "".join(
    f""",
errors_{m} AS MATERIALIZED (
  SELECT round(prediction - label, 6) AS residual FROM predictions WHERE model = '{m}'),
size_{m} AS MATERIALIZED (
  SELECT count(*) AS n, min(residual) AS low, max(residual) AS high,
         stddev_samp(residual) * power(count(*), -1.0 / 5) AS h FROM errors_{m}),
lattice_{m} AS MATERIALIZED (
  SELECT (residual - low) / (h / {PER_BANDWIDTH}) AS spot FROM errors_{m}, size_{m})"""
    for m in MEAN_MODELS
)


def bin_sql(column: str) -> str:
    """The filled bins of a column's histogram as rows of the chart table."""
    return f"""
SELECT 'histogram' AS chart, '{column}' AS label, bin AS place, CAST(frequency AS DOUBLE) AS value
FROM ({histogram_sql('processed', column)}) WHERE frequency > 0"""


def chart_sql() -> str:
    pairs = "\nUNION ALL ".join(
        f"SELECT 'correlation' AS chart, '{a}/{b}' AS label, 0 AS place,"
        f" round(CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END, 6) AS value FROM processed"
        for i, a in enumerate([*FEATURES, TARGET])
        for b in [*FEATURES, TARGET][i + 1 :]
    )
    means = """
SELECT 'hour' AS chart, CASE WHEN is_weekend = 1 THEN 'weekend' ELSE 'weekday' END AS label,
       request_hour AS place, round(avg(wait_minutes), 6) AS value
FROM processed GROUP BY request_hour, is_weekend
UNION ALL
SELECT 'month', 'all', trip_month, round(avg(wait_minutes), 6) FROM processed GROUP BY trip_month
UNION ALL
SELECT 'top_zone', '(' || PUBorough || ') ' || PULocationZone, CAST(place AS INTEGER), round(mean, 6)
FROM (SELECT *, row_number() OVER (ORDER BY mean DESC, PULocationZone, PUBorough) AS place
      FROM (SELECT PULocationZone, PUBorough, avg(wait_minutes) AS mean
            FROM processed GROUP BY PULocationZone, PUBorough))
WHERE place <= 10
UNION ALL
SELECT 'zone_map', s.zone, s.shape_id, round(coalesce(mean, 0), 6)
FROM shapes s LEFT JOIN (SELECT PULocationZone, avg(wait_minutes) AS mean
                         FROM processed GROUP BY PULocationZone, PUBorough) m ON s.zone = m.PULocationZone"""
    bins = "\nUNION ALL ".join(map(bin_sql, HISTOGRAM_FEATURES))
    return f"SELECT chart, label, CAST(place AS INTEGER) AS place, value FROM ({pairs}\nUNION ALL {means}\nUNION ALL {bins})"


def density_sql(model: str) -> str:
    return f"""
SELECT '{model}' AS model, CAST(point AS INTEGER) AS point, round(x, 6) AS x,
       round(sum(weight * exp(-0.5 * ((x - (low + place * (h / {PER_BANDWIDTH}))) / h) ** 2))
             / (any_value(n) * any_value(h) * sqrt(2 * pi())), 12) AS density
FROM (SELECT point, low + point * ((high - low) / {DENSITY_POINTS - 1}) AS x, n, h, low
      FROM size_{model}, range({DENSITY_POINTS}) t(point)) g,
     (SELECT place, sum(weight) AS weight
      FROM (SELECT floor(spot) AS place, 1 - (spot - floor(spot)) AS weight FROM lattice_{model}
            UNION ALL SELECT floor(spot) + 1, spot - floor(spot) FROM lattice_{model})
      GROUP BY place) w
GROUP BY point, x"""


METRICS = f"""{c.PREDICTIONS},
metrics AS (
  SELECT model, count(*) AS n, avg((prediction - label) ** 2) AS mse,
         avg(abs(prediction - label)) AS mae, var_pop(label) AS variance
  FROM predictions GROUP BY model)"""
MEAN_OF = "round(avg(wait_minutes), 6) AS avg_wait_minutes FROM processed"

def charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All chart tables of the processed rows as one table."""
    summary = chart_summary(c.processed(spark, sf_dir), c.shapes(spark, sf_dir))
    return summary.select("chart", "label", "place", c.rounded("value"))


def sketch_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of two columns from sketches by month that arrived in two parts: whether each is near its rank.

    The second part brings later months and one earlier month again.
    """
    lines = views.order_trips(spark, sf_dir).select(
        F.month("request_datetime").alias("trip_month"),
        F.col("order_id").cast("double").alias("order_id"),
        F.datediff("on_scene_datetime", "request_datetime").alias("days"),
    )
    lines = materialize(lines, "lines")
    path = scratch_path(spark, "sketches")
    update_sketches(lines.filter("trip_month <= 6"), path, ["order_id", "days"])
    update_sketches(lines.filter("trip_month >= 6"), path, ["order_id", "days"])
    found = sketched_quantiles(spark, path, QUARTILES).collect()
    checks = []
    for r in found:
        for p, q in zip(QUARTILES, r["quantiles"]):
            value = F.col(r["column_name"])
            near = (F.avg((value < q).cast("int")) <= p + RANK_ERROR) & (F.avg((value <= q).cast("int")) >= p - RANK_ERROR)
            head = [F.lit(r["column_name"]).alias("column_name"), F.lit(p).alias("p"), F.lit(r["rows"]).alias("n")]
            checks.append(lines.agg(near.alias("near")).select(*head, "near"))
    return reduce(DataFrame.unionByName, checks)


QUERIES = {
    "chart_tables": charts,
    "sketch_quartiles": sketch_quartiles,
    "quartiles": quartiles,
    "avg_wait_by_zone": by_zone,
    "monthly_trend": by_month,
    "collect_small": collected_months,
    "hourly_trend": by_hour,
    "hourly_trend_split": by_hour_split,
    "top10_zones": longest_zones,
    "histogram": feature_histograms,
    "correlation_matrix": correlations,
    "describe_target": describe_target,
    "error_histogram": error_histogram,
    "error_density": error_density,
    "regression_metrics": metrics,
    "compare_models": comparison,
}

ORACLE = {
    "chart_tables": c.with_(f"{c.PROCESSED}, {c.SHAPES}", chart_sql()),
    "sketch_quartiles": c.with_(
        c.ORDER_TRIPS,
        """SELECT column_name, p, (SELECT count(*) FROM order_trips) AS n, true AS near
FROM (VALUES ('order_id'), ('days')) c(column_name), (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) p(p)""",
    ),
    "quartiles": """SELECT count(*) AS n, quantile_cont(l_extendedprice, 0.25) AS p25,
       quantile_cont(l_extendedprice, 0.5) AS p50, quantile_cont(l_extendedprice, 0.75) AS p75
FROM lineitem""",
    "avg_wait_by_zone": c.with_(
        c.PROCESSED,
        f"SELECT PULocationZone, PUBorough, {MEAN_OF} GROUP BY PULocationZone, PUBorough",
    ),
    "collect_small": c.with_(
        c.ORDER_TRIPS,
        """SELECT CAST(month(request_datetime) AS INTEGER) AS trip_month, count(*) AS n
FROM order_trips GROUP BY 1""",
    ),
    "monthly_trend": c.with_(
        c.ORDER_TRIPS,
        f"""SELECT trip_month, round(avg(wait_minutes), 6) AS avg_wait
FROM (SELECT CAST(month(request_datetime) AS INTEGER) AS trip_month,
             {c.wait_sql()} AS wait_minutes
      FROM order_trips WHERE request_datetime <= on_scene_datetime)
GROUP BY trip_month""",
    ),
    "hourly_trend": c.with_(
        c.PROCESSED,
        f"SELECT request_hour, is_weekend, {MEAN_OF} GROUP BY request_hour, is_weekend",
    ),
    "hourly_trend_split": c.with_(
        c.PROCESSED,
        """SELECT request_hour,
       round(avg(wait_minutes) FILTER (WHERE is_weekend = 0), 6) AS weekday_wait,
       round(avg(wait_minutes) FILTER (WHERE is_weekend = 1), 6) AS weekend_wait
FROM processed GROUP BY request_hour""",
    ),
    "top10_zones": c.with_(
        c.PROCESSED,
        """SELECT PULocationZone, PUBorough, round(mean, 6) AS avg_wait_minutes,
       '(' || PUBorough || ') ' || PULocationZone AS formatted_zone
FROM (SELECT PULocationZone, PUBorough, avg(wait_minutes) AS mean
      FROM processed GROUP BY PULocationZone, PUBorough)
ORDER BY mean DESC, PULocationZone, PUBorough LIMIT 10""",
    ),
    "histogram": c.with_(
        c.PROCESSED,
        "\nUNION ALL ".join(
            histogram_sql("processed", f) for f in [*HISTOGRAM_FEATURES, TARGET]
        ),
    ),
    "correlation_matrix": c.with_(c.PROCESSED, correlation_sql([*FEATURES, TARGET])),
    "describe_target": c.with_(
        c.PROCESSED,
        """SELECT count(*) AS count, round(avg(wait_minutes), 6) AS mean,
       round(stddev_samp(wait_minutes), 6) AS std, round(min(wait_minutes), 6) AS min,
       round(quantile_cont(wait_minutes, 0.25), 6) AS p25,
       round(quantile_cont(wait_minutes, 0.5), 6) AS p50,
       round(quantile_cont(wait_minutes, 0.75), 6) AS p75, round(max(wait_minutes), 6) AS max
FROM processed""",
    ),
    "error_histogram": c.with_(
        ERRORS,
        "\nUNION ALL ".join(
            f"SELECT '{m}' AS model, bin, lower_edge, upper_edge, frequency"
            f" FROM ({histogram_sql(f'errors_{m}', 'residual')})"
            for m in MEAN_MODELS
        ),
    ),
    "error_density": c.with_(ERRORS, "\nUNION ALL ".join(map(density_sql, MEAN_MODELS))),
    "regression_metrics": c.with_(
        METRICS,
        """SELECT model, n, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse,
       round(mae, 6) AS mae, round(1 - mse / variance, 6) AS r2 FROM metrics""",
    ),
    "compare_models": c.with_(
        METRICS,
        """SELECT metric, max(CASE WHEN model = 'hour_mean' THEN text END) AS hour_mean,
       max(CASE WHEN model = 'zone_mean' THEN text END) AS zone_mean
FROM (SELECT model, 'MSE' AS metric, printf('%.4f', mse) AS text FROM metrics
      UNION ALL SELECT model, 'RMSE', printf('%.4f', sqrt(mse)) FROM metrics
      UNION ALL SELECT model, 'MAE', printf('%.4f', mae) FROM metrics
      UNION ALL SELECT model, 'R²', printf('%.4f', 1 - mse / variance) FROM metrics)
GROUP BY metric""",
    ),
}
