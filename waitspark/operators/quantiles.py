"""Exact quantiles by value counts.

Rows are first reduced to one row per distinct value, so a value that many rows share weighs no
more than any other. Where even the distinct values are many, they are narrowed to brackets
around the wanted ranks before one task sees them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.workspace import materialize

QUARTILES = (0.25, 0.75)
# Distinct values up to which each task may keep its own counts, and up to which one task may
# keep all of them.
TASK_VALUE_LIMIT = 20_000
VALUE_LIMIT = 100_000
CUTS = 128


def values_only(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` with NaN in ``columns`` as null: it is no value, and no quantile may see it."""
    kinds = dict(df.dtypes)
    floats = [c for c in dict.fromkeys(columns) if kinds[c] in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def value_counts(df: DataFrame, column: str, weight: str | None = None) -> DataFrame:
    """(value, n) for each distinct value, null included."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.groupBy(F.col(column).alias("value")).agg(n.alias("n"))


def quantile_array(column: str, probs: Sequence[float], weight: str | None) -> Column:
    """Interpolated quantiles as one array; null if the column holds no value."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    return F.percentile(column, wanted, F.col(weight) if weight else F.lit(1))


def row_total(weight: str | None) -> Column:
    return F.coalesce(F.sum(weight), F.lit(0)) if weight else F.count(F.lit(1))


def exact_quantiles(
    df: DataFrame,
    column: str,
    probs: Sequence[float] = QUARTILES,
    weight: str | None = None,
    distinct_values: int | None = None,
    value_limit: int = VALUE_LIMIT,
) -> tuple[int, list[float] | None]:
    """(rows, quantiles); the quantiles are None if ``column`` holds no value.

    ``distinct_values`` is an upper estimate of the distinct values, counted here if not given.
    """
    df = values_only(df, [column])
    if distinct_values is None:
        distinct_values = df.agg(F.approx_count_distinct(column)).first()[0]
    # The estimate may be some percent low, hence the margin.
    at_most = 1.25 * distinct_values
    if at_most > min(TASK_VALUE_LIMIT, value_limit):
        df = value_counts(df, column, weight)
        column, weight = "value", "n"
    if at_most > value_limit:
        df = clamp_to_brackets(materialize(df, "values"), probs, value_limit)
    quantiles = quantile_array(column, probs, weight)
    row = df.agg(row_total(weight).alias("n"), quantiles.alias("q")).first()
    return row["n"], row["q"]


def clamp_to_brackets(
    counts: DataFrame, probs: Sequence[float], value_limit: int
) -> DataFrame:
    """Value counts with the same quantiles at ``probs`` but at most about ``value_limit`` rows.

    A value between two brackets moves to the edge of the next one. That keeps the order, so the
    ranks inside the brackets still belong to the same values.
    """
    present = counts.filter(F.col("value").isNotNull())
    row = present.agg(
        F.sum("n"), F.count("value"), F.min("value"), F.max("value"), cut_points()
    ).first()
    if row[0] is None:
        return counts
    per_bracket = max(value_limit // len(probs), 2 * CUTS)
    whole = Bracket(float(row[2]), float(row[3]), row[1])
    positions = [p * (row[0] - 1) for p in probs]
    brackets = sorted(narrow(present, positions, whole, per_bracket, row[4]))
    value = F.col("value")
    clamped = F.when(value.isNull(), value)
    for bracket in brackets:
        clamped = clamped.when(
            value <= F.lit(bracket.high), F.greatest(value, F.lit(bracket.low))
        )
    clamped = clamped.otherwise(F.lit(brackets[-1].high))
    return counts.groupBy(clamped.alias("value")).agg(F.sum("n").alias("n"))


class Bracket(NamedTuple):
    low: float
    high: float
    values: int


def cut_points() -> Column:
    steps = F.array(*[F.lit(i / CUTS) for i in range(1, CUTS)])
    return F.percentile_approx("value", steps, 10 * CUTS)


def narrow(
    counts: DataFrame,
    positions: Sequence[float],
    whole: Bracket,
    limit: int,
    cuts: Sequence[float],
) -> set[Bracket]:
    """Brackets around the ranks next to each position, with at most ``limit`` values in each.

    A round cuts a bracket at evenly spread distinct values and counts the pieces: two aggregates,
    after which about 1/128 of the values remain; ``cuts`` are those of the first round. The pieces
    are counted over all rows, so ranks need no carrying over.
    """
    around = dict.fromkeys(positions, whole)
    while wide := {b for b in around.values() if b.values > limit}:
        for bracket in wide:
            if bracket != whole:
                inside = F.col("value").between(F.lit(bracket.low), F.lit(bracket.high))
                cuts = counts.filter(inside).agg(cut_points()).first()[0]
            pieces = cut(counts, bracket, cuts)
            for position, current in around.items():
                if current == bracket:
                    around[position] = pick(pieces, position)
    return set(around.values())


def cut(
    counts: DataFrame, bracket: Bracket, cuts: Sequence[float]
) -> list[tuple[float, float, int, int]]:
    """(low, high, rows, values) of the pieces of the whole value range, in order.

    The greatest finite value of the bracket is a piece of its own, apart from what lies above, and so
    is either infinity.
    """
    edges = sorted({e for e in (bracket.low, bracket.high, *map(float, cuts)) if math.isfinite(e)})
    edges = edges or [0.0]
    above = math.nextafter(edges[-1], math.inf)
    splits = [-math.inf, *edges, *([above] if above < math.inf else []), math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol="value", outputCol="piece")
    placed = bucketizer.transform(counts.withColumn("value", F.col("value").cast("double")))
    last = len(splits) - 1
    piece = F.when(F.col("value") == -math.inf, -1.0).when(F.col("value") == math.inf, float(last))
    placed = placed.withColumn("piece", piece.otherwise(F.col("piece")))
    found = placed.groupBy("piece").agg(F.sum("n"), F.count(F.lit(1))).collect()
    sizes = {int(r[0]): (r[1], r[2]) for r in found}
    ends = [(-math.inf, -math.inf), *zip(splits, splits[1:]), (math.inf, math.inf)]
    ends[len(edges) + 1] = (edges[-1], edges[-1])
    return [(*pair, *sizes.get(i - 1, (0, 0))) for i, pair in enumerate(ends)]


def pick(pieces: Sequence[tuple[float, float, int, int]], position: float) -> Bracket:
    """The pieces from the one with the rank below ``position`` to the one with the rank above."""
    first, last = math.floor(position), math.ceil(position)
    before, chosen = 0, []
    for low, high, rows, values in pieces:
        if rows and before <= last and before + rows > first:
            chosen.append((low, high, values))
        before += rows
    return Bracket(chosen[0][0], chosen[-1][1], sum(v for _, _, v in chosen))
