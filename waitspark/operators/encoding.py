"""Dictionary codes of a category column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from waitspark.workspace import local_table, materialize

LOCAL_LIMIT = 10_000


def category_codes(
    df: DataFrame, column: str, local_limit: int = LOCAL_LIMIT
) -> DataFrame:
    """(column, code): codes 1..n in alphabetical order; null gets no entry.

    A short list is numbered on the driver. A longer one is sorted over all tasks.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    values = values.orderBy(column)
    found = values.limit(local_limit + 1).collect()
    if len(found) > local_limit:
        return sorted_codes(values, column)
    schema = T.StructType([values.schema[column], T.StructField("code", T.IntegerType())])
    rows = [(row[0], i + 1) for i, row in enumerate(found)]
    return local_table(df.sparkSession, rows, schema)


def sorted_codes(values: DataFrame, column: str) -> DataFrame:
    """Codes of sorted distinct values, without one task holding them all.

    A value's code is its place within its part of the sorted table plus the sizes of the parts
    before it.
    """
    place = F.monotonically_increasing_id()
    placed = values.select(
        column,
        F.shiftright(place, 33).alias("part"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    placed = materialize(placed, "categories")
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row per part of the sorted table, never more than the shuffle has partitions.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")
    )
    code = (F.col("offset") + F.col("place") + 1).cast("int")
    coded = placed.join(F.broadcast(offsets), "part").select(column, code.alias("code"))
    return materialize(coded, "codes")


def apply_codes(
    df: DataFrame, codes: DataFrame, column: str, output: str
) -> DataFrame:
    """Adds ``output``: the value's code, 0 for null or unknown."""
    named = codes.select(column, F.col("code").alias("_found_code"))
    coded = df.join(named, column, "left")
    return coded.withColumn(output, F.coalesce("_found_code", F.lit(0))).drop("_found_code")


def encode_category(
    df: DataFrame, column: str, output: str
) -> tuple[DataFrame, DataFrame]:
    """(``df`` with ``output``, the dictionary)."""
    codes = category_codes(df, column)
    return apply_codes(df, codes, column, output), codes
