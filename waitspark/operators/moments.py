"""Means and co-moments of all pairs of columns in one pass, whatever is missing in which row.

A pair of columns has moments of its own, over the rows where both are present. A task keeps, for all
pairs at once, the counts, the means and the sums of centred products as matrices, and takes a
batch by a few matrix products; states of tasks merge by the usual update for two samples, which loses
no digits to large means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.operators.folding import fold_states, numbers, task_states


@dataclass
class PairMoments:
    """Element (i, j) is over the rows where columns i and j are present.

    ``mean`` and ``square`` are of column i; ``cross`` is the sum of products of both columns' distances
    from their means.
    """

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray, present: np.ndarray) -> PairMoments:
        mask = present.astype(float)
        counts = mask.sum(axis=0)
        shift = np.divide(values.sum(axis=0), counts, out=np.zeros(len(counts)), where=counts > 0)
        near = np.where(present, values - shift, 0.0)
        n = mask.T @ mask
        sums = near.T @ mask
        mean = np.divide(sums, n, out=np.zeros_like(sums), where=n > 0)
        square = (near * near).T @ mask - n * mean * mean
        cross = near.T @ near - n * mean * mean.T
        return cls(n, np.where(n > 0, mean + shift[:, None], 0.0), np.maximum(square, 0), cross)

    def merge(self, other: PairMoments) -> PairMoments:
        n = self.n + other.n
        share = np.divide(other.n, n, out=np.zeros_like(n), where=n > 0)
        apart = other.mean - self.mean
        weight = self.n * share
        return PairMoments(
            n,
            self.mean + apart * share,
            self.square + other.square + apart * apart * weight,
            self.cross + other.cross + apart * apart.T * weight,
        )

    def correlations(self) -> np.ndarray:
        """NaN where a column does not vary over the pair's rows."""
        # Rounding leaves a column of equal values a spread of about its size times the precision.
        least = (np.abs(self.mean) * 1e-14) ** 2 * np.maximum(self.n, 1)
        varies = (self.square > least) & (self.square > 0)
        both = varies & varies.T
        scale = np.sqrt(np.where(both, self.square * self.square.T, 1.0))
        found = np.where(both, self.cross / scale, np.nan)
        own = np.arange(len(found))
        found[own, own] = np.where(varies[own, own], 1.0, np.nan)
        return found


def pair_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    """The moments of all pairs of ``columns``; null and NaN are no values."""
    size = len(columns)

    def take(state: PairMoments | None, batch: pa.RecordBatch) -> PairMoments:
        found = PairMoments.of(*numbers(batch))
        return found if state is None else state.merge(found)

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    found = fold_states(task_states(rows, take), PairMoments.merge)
    return found or PairMoments(*[np.zeros((size, size)) for _ in range(4)])
