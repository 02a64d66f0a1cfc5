"""Interquartile fences, column after column.

The quartiles of a column come from the rows that every earlier fence kept. All that needs is how
often each combination of the fenced columns occurs, so the input is reduced to a table of that,
written once, and the fences are found there; the result is the input itself under literal bounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.quantiles import (
    QUARTILES,
    TASK_VALUE_LIMIT,
    VALUE_LIMIT,
    exact_quantiles,
    quantile_array,
    row_total,
    values_only,
)
from waitspark.workspace import materialize

# Rows per combination from which grouping pays.
MIN_REPEAT = 2
REPORT_SCHEMA = (
    "step int, column_name string, lower_bound double, upper_bound double,"
    " rows_before long, anomaly_rows long, anomaly_percent double, rows_after long"
)


@dataclass(frozen=True)
class Fence:
    column: str
    lower: float | None
    upper: float | None
    rows_before: int

    def removes(self, found: ColumnSummary) -> bool:
        """Whether any row of a summarised column lies outside."""
        if self.lower is None or found.gaps:
            return True
        return found.least < self.lower or found.greatest > self.upper

    def keeps(self) -> Column:
        """Inclusive; a null or NaN, or a column without values, keeps nothing."""
        bounds = [F.lit(b).cast("double") for b in (self.lower, self.upper)]
        return F.col(self.column).between(*bounds)


@dataclass(frozen=True)
class Fences:
    steps: list[Fence]
    rows_after: int

    def apply(self, df: DataFrame) -> DataFrame:
        for fence in self.steps:
            df = df.filter(fence.keeps())
        return df

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per column in fence order, then one for all together."""
        totals = [f.rows_before for f in self.steps] + [self.rows_after]
        rows = [
            _report_row(i + 1, f.column, f.lower, f.upper, totals[i], totals[i + 1])
            for i, f in enumerate(self.steps)
        ]
        rows.append(_report_row(0, "(all)", None, None, totals[0], totals[-1]))
        return spark.createDataFrame(rows, REPORT_SCHEMA)


def _report_row(step, column, lower, upper, before, after) -> tuple:
    removed = before - after
    ratio = removed * 100.0 / before if before else 0.0
    return step, column, lower, upper, before, removed, ratio, after


def combination_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columns..., n): how many rows share each combination, written once."""
    columns = list(dict.fromkeys(columns))
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return materialize(counts, "combinations")


def weighted_rows(
    df: DataFrame, columns: Sequence[str]
) -> tuple[DataFrame, dict[str, int]]:
    """(the fenced columns with a weight ``n``, written once; distinct values of each column).

    Grouped where combinations repeat; where nearly all differ, grouping would only shuffle the
    table, so the rows are written as they are.
    """
    columns = list(dict.fromkeys(columns))
    df = values_only(df, columns)
    row = df.agg(
        F.count(F.lit(1)),
        F.approx_count_distinct(F.struct(*columns)),
        *[F.approx_count_distinct(c) for c in columns],
    ).first()
    sizes = dict(zip(columns, row[2:]))
    if row[1] * MIN_REPEAT <= row[0]:
        return combination_counts(df, columns), sizes
    return materialize(df.select(*columns, F.lit(1).alias("n")), "fenced"), sizes


def distinct_values(df: DataFrame, columns: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.approx_count_distinct(c) for c in columns]).first()
    return dict(zip(columns, row))


def fences_from_counts(
    counts: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    value_limit: int = VALUE_LIMIT,
    sizes: dict[str, int] | None = None,
) -> Fences:
    """Fences of weighted rows; ``counts`` carries the weight in ``n``.

    One aggregate gives the quartiles of all columns still to come. They stay right until a fence
    removes a row, so most columns need no pass of their own.
    """
    counts = values_only(counts, columns)
    sizes = sizes or distinct_values(counts, columns)
    narrow = [c for c in columns if 1.25 * sizes[c] <= min(TASK_VALUE_LIMIT, value_limit)]
    steps, summary, rows = [], {}, None
    for i, column in enumerate(columns):
        if column in narrow and column not in summary:
            rows, summary = summarize(counts, [c for c in columns[i:] if c in narrow])
        if column in summary:
            found = summary[column]
            fence = _fence(column, found.quartiles, rows, k)
            removes = fence.removes(found)
        else:
            rows, quartiles = exact_quantiles(
                counts, column, QUARTILES, "n", sizes[column], value_limit
            )
            fence, removes = _fence(column, quartiles, rows, k), True
        steps.append(fence)
        if removes:
            counts, summary, rows = counts.filter(fence.keeps()), {}, None
    if rows is None:
        rows = counts.agg(row_total("n")).first()[0]
    return Fences(steps, rows)


@dataclass(frozen=True)
class ColumnSummary:
    quartiles: list[float] | None
    least: float | None
    greatest: float | None
    gaps: int


def summarize(
    counts: DataFrame, columns: Sequence[str]
) -> tuple[int, dict[str, ColumnSummary]]:
    """(rows, quartiles, extremes and null rows of each column), in one aggregate."""
    parts = [row_total("n").alias("rows")]
    for c in columns:
        nulls = F.sum(F.when(F.col(c).isNull(), F.col("n")).otherwise(0))
        quartiles = quantile_array(c, QUARTILES, "n")
        parts.append(F.struct(quartiles, F.min(c), F.max(c), nulls).alias(c))
    row = counts.agg(*parts).first()
    return row["rows"], {c: ColumnSummary(*row[c]) for c in columns}


def approximate_fences(
    df: DataFrame, columns: Sequence[str], k: float = 1.5, error: float = 0.01
) -> Fences:
    """Fences from quartiles of bounded rank error; a data value each, no interpolation."""
    rest = materialize(df.select(*dict.fromkeys(columns)), "fenced")
    rows = rest.count()
    steps = []
    for column in columns:
        quartiles = rest.approxQuantile(column, list(QUARTILES), error) or None
        steps.append(_fence(column, quartiles, rows, k))
        rest = rest.filter(steps[-1].keeps())
        rows = rest.count()
    return Fences(steps, rows)


def _fence(column: str, quartiles, rows: int, k: float) -> Fence:
    if not quartiles:
        return Fence(column, None, None, rows)
    q1, q3 = quartiles
    reach = k * (q3 - q1)
    return Fence(column, q1 - reach, q3 + reach, rows)


def iqr_fences(
    df: DataFrame,
    columns: Sequence[str],
    k: float = 1.5,
    approx: bool = False,
    value_limit: int = VALUE_LIMIT,
) -> Fences:
    """The fences of ``columns`` in order; ``approx`` allows quartiles a rank error of 1 %."""
    if approx:
        return approximate_fences(df, columns, k)
    counts, sizes = weighted_rows(df, columns)
    return fences_from_counts(counts, columns, k, value_limit, sizes)


def drop_numeric_anomalies(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    return iqr_fences(df, columns, **options).apply(df)
