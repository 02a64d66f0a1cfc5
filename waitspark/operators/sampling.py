"""Sampling without replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from waitspark.functions.hashing import in_hash_sample
from waitspark.schema import SEED


def sample(df: DataFrame, fraction: float | None, seed: int = SEED) -> DataFrame:
    """Bernoulli sample; all rows unless 0 < fraction < 1. Depends on the partitioning."""
    if fraction is None or not 0 < fraction < 1:
        return df
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Sample by a hash of the key columns: the same rows under any partitioning."""
    if not 0 < fraction < 1:
        return df
    return df.filter(in_hash_sample(keys, fraction))
