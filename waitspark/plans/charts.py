"""The tables behind the charts of the processed data."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.operators.aggregates import (
    TOP_ZONES,
    hourly_series,
    mean_wait_by_month,
    mean_wait_by_zone,
    top_zones,
)
from waitspark.functions.text import zone_label
from waitspark.operators.distributions import BINS, bin_edges, correlation_matrix, histogram
from waitspark.operators.joins import zone_map
from waitspark.operators.sampling import sample
from waitspark.schema import FEATURES, HISTOGRAM_FEATURES, TARGET
from waitspark.workspace import materialize


def chart_tables(
    processed: DataFrame, shapes: DataFrame, fraction: float | None = None
) -> dict[str, DataFrame]:
    """Feature histograms, correlations, hourly, zone and monthly waits, and the zone map.

    ``processed`` should be a written table: each entry reads the columns it needs.
    """
    rows = sample(processed, fraction)
    zone_means = mean_wait_by_zone(rows).select("PULocationZone", "avg_wait_minutes")
    return {
        "histograms": histogram(rows, HISTOGRAM_FEATURES),
        "correlations": correlation_matrix(rows, [*FEATURES, TARGET]),
        "hourly": hourly_series(rows),
        "top_zones": top_zones(rows),
        "monthly": mean_wait_by_month(rows),
        "zone_map": zone_map(shapes, zone_means),
    }


def _bin(column: str, edges: list[float]) -> Column:
    """The bin of a value among equal-width ``edges``, by the edges themselves; the last holds its upper edge."""
    width = (edges[-1] - edges[0]) / (len(edges) - 1)
    value = F.col(column).cast("double")
    near = F.floor((value - F.lit(edges[0])) / F.lit(width))
    bounds = F.array(*map(F.lit, edges))
    at = F.least(F.greatest(near, F.lit(0)), F.lit(len(edges) - 2)).cast("int")
    # The quotient may round to the neighbour of the right bin.
    at = at - F.when(value < F.get(bounds, at), 1).otherwise(0)
    return at + F.when((at < len(edges) - 2) & (value >= F.get(bounds, at + 1)), 1).otherwise(0)


def chart_summary(processed: DataFrame, shapes: DataFrame) -> DataFrame:
    """(chart, label, place, value): every chart of the processed rows in one table.

    Two passes over the rows whatever the number of charts: one aggregate for extremes and
    correlations, and one with a grouping set for each chart, combined in the tasks to as many rows as
    the charts have. Charts are ``histogram`` (label: feature, place: bin, filled bins only),
    ``correlation`` (label: both names), ``hour`` (label: kind of day, place: hour), ``month``,
    ``top_zone`` (place: rank) and ``zone_map`` (place: shape_id).
    """
    columns = [*FEATURES, TARGET]
    numbers = {c: F.col(c).cast("double") for c in columns}
    clean = {c: F.when(~F.isnan(v), v) for c, v in numbers.items()}
    complete = reduce(lambda a, b: a & b, [clean[c].isNotNull() for c in HISTOGRAM_FEATURES])
    pairs = list(combinations(columns, 2))
    rows = processed.select(*columns, "trip_month", "PULocationZone", "PUBorough")
    head = rows.agg(
        *[F.struct(F.min(F.when(complete, clean[c])), F.max(F.when(complete, clean[c]))) for c in HISTOGRAM_FEATURES],
        F.array(*[_correlation(clean[a], clean[b]) for a, b in pairs]).alias("r"),
    ).first()
    bins = [f"bin_{c}" for c in HISTOGRAM_FEATURES]
    edges = [bin_edges(*head[i], BINS) for i in range(len(bins))]
    binned = rows.withColumns(
        {b: F.when(complete, _bin(c, e)) for b, c, e in zip(bins, HISTOGRAM_FEATURES, edges)}
    )
    keys = ["request_hour", "is_weekend", "trip_month", "PULocationZone", "PUBorough", *bins]
    sets = [keys[:2], [keys[2]], keys[3:5], *[[b] for b in bins]]
    grouped = binned.groupingSets([[F.col(k) for k in s] for s in sets], *map(F.col, keys)).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("mean")
    )
    grouped = materialize(grouped, "charts")

    def of(chosen: list[str]) -> DataFrame:
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in chosen)
        return grouped.filter(F.col("gid") == gid)

    def chart(df: DataFrame, name: str, label: Column, place: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("chart"), label.alias("label"), place.cast("int").alias("place"), value.cast("double").alias("value")
        )

    day = F.when(F.col("is_weekend") == 1, "weekend").otherwise("weekday")
    zones = of(keys[3:5])
    longest = zones.orderBy(F.desc("mean"), "PULocationZone", "PUBorough").limit(TOP_ZONES)
    ranked = longest.agg(F.collect_list(F.struct("mean", "PULocationZone", "PUBorough")).alias("zones"))
    ranked = ranked.select(F.posexplode("zones").alias("rank", "zone")).select(F.col("rank") + 1, "zone.*")
    ranked = ranked.toDF("rank", "mean", "PULocationZone", "PUBorough")
    means = zones.select("PULocationZone", F.col("mean").alias("avg_wait_minutes"))
    spark = processed.sparkSession
    correlations = spark.createDataFrame(
        [("correlation", f"{a}/{b}", 0, r) for (a, b), r in zip(pairs, head["r"])],
        "chart string, label string, place int, value double",
    )
    parts = [
        correlations,
        chart(of(keys[:2]), "hour", day, F.col("request_hour"), F.col("mean")),
        chart(of([keys[2]]), "month", F.lit("all"), F.col("trip_month"), F.col("mean")),
        chart(ranked, "top_zone", zone_label(F.col("PUBorough"), F.col("PULocationZone")), F.col("rank"), F.col("mean")),
        chart(zone_map(shapes, means), "zone_map", F.col("zone"), F.col("shape_id"), F.col("avg_wait_minutes")),
    ]
    for feature, b in zip(HISTOGRAM_FEATURES, bins):
        parts.append(chart(of([b]).filter(F.col(b).isNotNull()), "histogram", F.lit(feature), F.col(b), F.col("n")))
    return reduce(DataFrame.unionByName, parts)


def _correlation(a: Column, b: Column) -> Column:
    both = a.isNotNull() & b.isNotNull()
    spreads = [F.stddev_pop(F.when(both, v)) for v in (a, b)]
    return F.try_divide(F.covar_pop(a, b), spreads[0] * spreads[1])
