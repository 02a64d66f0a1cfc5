"""Counts of what cleaning steps remove, taken while their result is written.

The steps' conditions are counted by an observation of the rows before the first filter, so the job that
writes the result also fills the report; nothing is read for the report alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.cleaning import all_present, in_time_order
from waitspark.operators.fences import Fences

REPORT = "step int, name string, rows_before long, rows_removed long, percent_removed double, rows_after long"


@dataclass(frozen=True)
class ObservedSteps:
    """Rows that pass all steps, and the counts once a job has written or read all of them."""

    data: DataFrame
    names: list[str]
    observation: Observation

    def counts(self) -> list[int]:
        """Rows before the first step and after each; waits for a job over ``data`` to end."""
        found = self.observation.get
        return [found[f"after_{i}"] or 0 for i in range(len(self.names) + 1)]

    def report(self, spark: SparkSession) -> DataFrame:
        """One row for each step, then one for all together."""
        after = self.counts()
        rows = [_row(i + 1, name, after[i], after[i + 1]) for i, name in enumerate(self.names)]
        rows.append(_row(0, "(all)", after[0], after[-1]))
        return spark.createDataFrame(rows, REPORT)


def _row(step: int, name: str, before: int, after: int) -> tuple:
    removed = before - after
    return step, name, before, removed, removed * 100.0 / before if before else 0.0, after


def observed_steps(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> ObservedSteps:
    """``df`` filtered by the conditions of ``steps``, one after the other, with their counts observed.

    A row stays where a condition holds; null does not hold.
    """
    observation = Observation()
    kept = [F.coalesce(condition, F.lit(False)) for _, condition in steps]
    passed = [F.lit(True)]
    for condition in kept:
        passed.append(passed[-1] & condition)
    counts = [F.count_if(p).alias(f"after_{i}") for i, p in enumerate(passed)]
    watched = df.observe(observation, *counts)
    return ObservedSteps(reduce(DataFrame.filter, kept, watched), [name for name, _ in steps], observation)


def cleaning_steps(keys: Sequence[str], df: DataFrame, fences: Fences | None = None) -> list[tuple[str, Column]]:
    """Time order, keys that must be present, and one step for each fence, to be counted as rows are written."""
    steps = [("time order", in_time_order()), ("keys present", all_present(df, keys))]
    return steps + [(f"fence {f.column}", f.keeps()) for f in (fences.steps if fences else [])]


def write_observed(
    df: DataFrame, steps: Sequence[tuple[str, Column]], path: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace what is at ``path`` by the rows that pass ``steps``; the report, from the same job."""
    observed = observed_steps(df, steps)
    observed.data.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return observed.report(df.sparkSession)
