"""Quantile sketches of columns, kept by month beside the rows.

A sketch is a few kilobytes whatever it has seen, and sketches merge. So a month is read once, when it
arrives; quantiles over any months come from their sketches alone, and a month that arrives again
replaces its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.fences import Fence, Fences
from waitspark.operators.quantiles import QUARTILES

# Size parameter of a sketch: a rank error of about half a percent.
ACCURACY = 512


def column_sketches(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """(by, column_name, rows, sketch) of each column's values, one aggregate; null and NaN are no values."""
    kinds = dict(df.dtypes)
    parts = []
    for c in columns:
        value = F.col(c).cast("double")
        if kinds[c] in ("double", "float"):
            value = F.when(~F.isnan(c), value)
        parts.append(
            F.struct(F.lit(c).alias("column_name"), F.count(value).alias("rows"), F.kll_sketch_agg_double(value, F.lit(ACCURACY)).alias("sketch"))
        )
    found = df.groupBy(by).agg(F.array(*parts).alias("sketches"))
    return found.select(by, F.inline("sketches"))


def update_sketches(df: DataFrame, path: str, columns: Sequence[str], by: str = "trip_month") -> None:
    """Write the sketches of the months of ``df``, in the place of those that ``path`` has of them."""
    sketches = column_sketches(df, columns, by)
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(by).parquet(path)


def sketched_quantiles(spark: SparkSession, path: str, probs: Sequence[float], months: Sequence | None = None, by: str = "trip_month") -> DataFrame:
    """(column_name, rows, quantiles) from the sketches alone; null quantiles of a column without values."""
    stored = spark.read.parquet(path)
    if months is not None:
        stored = stored.filter(F.col(by).isin(list(months)))
    merged = stored.filter("rows > 0").groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_double("sketch", F.lit(ACCURACY)).alias("sketch")
    )
    wanted = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    found = merged.select("column_name", "rows", wanted.alias("quantiles"))
    names = stored.select("column_name").distinct()
    return names.join(found, "column_name", "left").select("column_name", F.coalesce("rows", F.lit(0)).alias("rows"), "quantiles")


def sketched_fences(spark: SparkSession, path: str, columns: Sequence[str], k: float = 1.5, months: Sequence | None = None) -> Fences:
    """Interquartile fences from the sketches alone.

    Each column's quartiles are over all rows, not over those that earlier fences keep: sketches cannot
    leave out the rows of another column's fence. So no fence has counts of the rows it removes.
    """
    found = {r["column_name"]: r for r in sketched_quantiles(spark, path, QUARTILES, months).collect()}
    steps = []
    for c in columns:
        row = found.get(c)
        if row is None or not row["rows"]:
            steps.append(Fence(c, None, None, 0))
            continue
        q1, q3 = row["quantiles"]
        steps.append(Fence(c, q1 - k * (q3 - q1), q3 + k * (q3 - q1), row["rows"]))
    return Fences(steps, 0)
