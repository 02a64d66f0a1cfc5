"""Row hashes that do not depend on partitioning and can be recomputed outside Spark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_unit(keys: Sequence[str], salt: str = "") -> Column:
    """A number in [0, 1) from the first 32 bits of the md5 of the key columns' text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", F.lit(salt), *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(2**32))


def in_hash_sample(keys: Sequence[str], fraction: float, salt: str = "") -> Column:
    return hash_unit(keys, salt) < F.lit(fraction)
