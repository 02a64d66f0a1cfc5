"""Histograms, correlations and densities, reduced on the executors."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.operators.cleaning import drop_null_keys
from waitspark.operators.moments import pair_moments

# Bins of a histogram, points of a density curve.
BINS = 30
DENSITY_POINTS = 200

# Lattice steps a bandwidth on which the density's values are weighed.
PER_BANDWIDTH = 2048


def bin_edges(low: float | None, high: float | None, bins: int) -> list[float]:
    """Equal-width edges; a single value gets a range of width 1 around it, no value gets 0..1."""
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    return [low + i * width for i in range(bins)] + [float(high)]


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(feature, bin, lower_edge, upper_edge, frequency) over rows without a null.

    A value on an edge belongs to the bin above it, but for the last edge. Two passes: extremes of
    all columns, then one count by column and bin, combined in each task to at most
    columns x bins rows before the shuffle. Empty bins are kept.
    """
    values = df.select(*[F.col(c).cast("double") for c in columns])
    complete = drop_null_keys(values, columns)
    extremes = complete.agg(*[F.struct(F.min(c), F.max(c)) for c in columns]).first()
    edges = {c: bin_edges(*extremes[i], bins) for i, c in enumerate(columns)}
    # With a bucket below the first edge even a single bin gives enough buckets.
    bucketizer = Bucketizer(
        splitsArray=[[-math.inf, *e] for e in edges.values()],
        inputCols=list(columns),
        outputCols=[f"bin_{c}" for c in columns],
    )
    places = [
        F.struct(F.lit(c).alias("feature"), (F.col(f"bin_{c}") - 1).cast("int").alias("bin"))
        for c in columns
    ]
    placed = bucketizer.transform(complete).select(F.inline(F.array(*places)))
    counts = placed.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("found"))
    frame = df.sparkSession.createDataFrame(
        [(c, i, e[i], e[i + 1]) for c, e in edges.items() for i in range(bins)],
        "feature string, bin int, lower_edge double, upper_edge double",
    )
    # Both sides hold at most columns x bins rows.
    joined = frame.join(F.broadcast(counts), ["feature", "bin"], "left")
    frequency = F.coalesce("found", F.lit(0)).alias("frequency")
    return joined.select("feature", "bin", "lower_edge", "upper_edge", frequency)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(row_name, column_name, r) of all pairs; null where a column does not vary.

    One pass for any number of columns. Each pair uses the rows where both are present, so a null or NaN
    takes its row out of that column's pairs only.
    """
    found = pair_moments(df, columns).correlations()
    rows = [
        (a, b, None if math.isnan(found[i, j]) else float(found[i, j]))
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows, "row_name string, column_name string, r double"
    )


def density_curve(
    df: DataFrame, column: str, points: int = DENSITY_POINTS
) -> DataFrame:
    """(point, x, density): Gaussian kernel density with Scott's bandwidth, from min to max.

    Null, NaN and infinity are no values. A value's weight goes to the two neighbours it has on a lattice of
    ``PER_BANDWIDTH`` steps a bandwidth, in proportion, so tasks sum weights by lattice place and the
    shuffle carries places, whose number grows with the fifth root of the rows, instead of values. The
    density differs from the exact one by less than 1 / (8 * PER_BANDWIDTH ** 2), 3e-8, of a kernel's
    peak. Each place then adds to every grid point in the task that holds it.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("value")).filter(F.abs(F.col("value")) < F.lit(math.inf))
    first = values.agg(
        F.count("value").alias("n"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
        F.stddev_samp("value").alias("spread"),
    ).first()
    if not first["n"] or first["low"] == first["high"]:
        schema = "point int, x double, density double"
        return df.sparkSession.createDataFrame([], schema)
    n, low, high = first["n"], float(first["low"]), float(first["high"])
    bandwidth = first["spread"] * n ** (-1 / 5)
    lattice = bandwidth / PER_BANDWIDTH

    at = (F.col("value") - F.lit(low)) / F.lit(lattice)
    rest = at - F.floor(at)
    shares = F.array(
        F.struct(F.floor(at).alias("place"), (F.lit(1.0) - rest).alias("weight")),
        F.struct((F.floor(at) + 1).alias("place"), rest.alias("weight")),
    )
    weights = values.select(F.inline(shares)).groupBy("place").agg(F.sum("weight").alias("weight"))

    step = (high - low) / (points - 1)
    x = F.lit(low) + F.col("point") * F.lit(step)
    spread = weights.select(
        "place", "weight", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    )
    z = (x - (F.lit(low) + F.col("place") * F.lit(lattice))) / F.lit(bandwidth)
    kernel = F.exp(z * z * F.lit(-0.5)) * F.col("weight")
    scale = n * bandwidth * math.sqrt(2 * math.pi)
    sums = spread.groupBy("point").agg((F.sum(kernel) / F.lit(scale)).alias("density"))
    return sums.select("point", x.alias("x"), "density").orderBy("point")
