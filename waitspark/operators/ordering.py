"""Places of rows in a total order, without bringing them into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitspark.workspace import discard, materialize


def with_positions(rows: DataFrame, order: Sequence[str | Column], output: str = "position") -> DataFrame:
    """``rows``, written once more, with their place from 0 by ``order``.

    Rows that are equal in ``order`` are dealt out by their place in the input, so copies of one row
    fill as many range partitions as they need. Each partition numbers its rows, and the counts of the
    ones before it shift them: a row for each partition is all that one task sees of the others.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tagged = materialize(rows.withColumn("_from", F.monotonically_increasing_id()), "rows")
    keys = [*order, "_from"]
    dealt = tagged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_from")
    dealt = materialize(dealt.withColumn("_id", F.monotonically_increasing_id()), "ordered")
    discard(tagged)
    counts = dealt.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.col("_id").bitwiseAND(F.lit(2**33 - 1))
    placed = dealt.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(starts), "_part")
    return placed.withColumn(output, F.col("_start") + within).drop("_id", "_part", "_start")
