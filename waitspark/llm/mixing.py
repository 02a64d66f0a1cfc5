"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target/size copies, at most ``MAX_COPIES``. Documents of a source
stand in a row ordered by size; the running sum of expected copies, shifted by one random offset
of the source, is cut at the integers, and a document is emitted once for each integer its stretch
crosses. Ordered by size, the words taken differ from the target by at most about one longest document.

The row of a source is never one task: documents are range-partitioned by (source, size, id) and
numbered inside the partitions; the starts of the partitions come from counts, one row for each
pair of partition and source.

Null text has size 0, null source is a source of its own (last in order), repeated rows are rows of
their own, empty input gives an empty result. Other columns are carried by ``mix`` and ignored by
``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitspark.functions.hashing import hash_unit
from waitspark.llm.common import WORD, free_names, text_or_empty
from waitspark.workspace import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SALT = "mix"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n_docs) -> also target, the share of all sizes that the source gets.

    Shares go by weight; what exceeds ``cap`` times a source's size goes to the others by weight,
    until none exceeds. In order of cap over weight this is one running sum: the first sources are
    full, and the rest share what is left. This table has a row per source, so one window holds it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("_i", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    numbered = numbered.withColumns({"_w": weight.cast("long"), "_cap": F.col("source_size") * cap})
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), "_i")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    shared = numbered.withColumns(
        {
            "_left": F.sum("source_size").over(whole) - F.coalesce(F.sum("_cap").over(before), F.lit(0)),
            "_weights": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0)),
        }
    )
    # What one unit of weight gets if the sources before are full: it rises while they overflow, then falls.
    shared = shared.withColumn("_level", F.col("_left") / F.col("_weights"))
    level = F.max("_level").over(whole)
    return shared.select(
        "source",
        "source_size",
        "n_docs",
        F.least(F.col("_cap").cast("double"), F.col("_w") * F.coalesce(level, F.lit(0.0))).alias("target"),
    )


def plan(docs: DataFrame, keys: list[str], weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """``keys``, size, source_size, target and copies for each row; ``keys`` identify and order rows."""
    narrow = docs.select(*keys, "source", F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long").alias("size"))
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = narrow.repartitionByRange(parts, F.col("source").asc_nulls_last(), "size", *keys)
    ordered = ordered.sortWithinPartitions(F.col("source").asc_nulls_last(), "size", *keys)
    ordered = materialize(ordered.withColumn("_place", F.monotonically_increasing_id()), "mix")
    part = F.shiftright("_place", 33)
    stretches = (
        ordered.groupBy("source", part.alias("_part"))
        .agg(F.min("_place").alias("_first"), F.count("*").alias("_n"), F.sum("size").alias("_size"))
    )
    stretches = materialize(stretches, "mix-parts")
    by_part = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = stretches.select(
        F.col("source").alias("_source"),
        F.col("_part"),
        (F.coalesce(F.sum("_n").over(by_part), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    totals = stretches.groupBy("source").agg(F.sum("_size").alias("source_size"), F.sum("_n").alias("n_docs"))
    shares = targets(totals, weights, cap).withColumn("_offset", hash_unit(["source"], SALT))
    shares = shares.withColumnRenamed("source", "_s")
    starts = starts.join(shares, F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    starts = materialize(starts, "mix-starts")
    placed = ordered.withColumn("_p", part).join(
        starts, (F.col("_p") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source"))
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    index = F.col("_place") + F.col("_shift")
    return placed.select(
        *keys, "source", "size", "source_size", "target", crossings(index, rate, F.col("_offset")).alias("copies")
    )


def crossings(index: Column, rate: Column, offset: Column) -> Column:
    """Integers in (index * rate + offset, (index + 1) * rate + offset]."""
    return (F.floor((index + 1) * rate + offset) - F.floor(index * rate + offset)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``.

    Rows are told apart by their place in the input, read from a written copy of the key columns'
    hash, so that repeated ids do not multiply each other.
    """
    key, number, twins, copy = free_names(docs.columns, "_key", "_copies", "_twins", "_copy")
    keyed = docs.withColumn(key, row_key(docs))
    copies = plan(keyed, [key], weights, cap)
    # Twins (equal in all columns) share a key: their copies are summed and dealt to each in turn.
    dealt = copies.groupBy(key).agg(F.sum("copies").alias(number), F.count("*").alias(twins))
    dealt = materialize(dealt.filter(F.col(number) > 0), "mix-copies")
    one = keyed.join(dealt, key)
    if dealt.filter(F.col(twins) > 1).limit(1).count():
        # Rows equal in every column are interchangeable: keep one of each and emit it for all.
        single = one.filter(F.col(twins) == 1)
        many = one.filter(F.col(twins) > 1).dropDuplicates([key])
        one = single.unionByName(many)
    return one.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(number).cast("int")))).select(*docs.columns)


def row_key(docs: DataFrame) -> Column:
    """A digest of all columns: equal for equal rows, else different.

    Each value goes in with its length, so no value can reach into the next.
    """
    parts = []
    for field in docs.schema.fields:
        value = F.col(f"`{field.name}`")
        nested = field.dataType.typeName() in ("array", "map", "struct", "variant")
        text = F.to_json(F.struct(value)) if nested else value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(F.when(value.isNotNull(), sized), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def op3(docs: DataFrame) -> DataFrame:
    return plan(docs, ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size
  FROM documents),
sizes AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, source_size * {MAX_COPIES} AS cap FROM sizes),
shared AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS DOUBLE)
            / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS share
  FROM weighed
  WINDOW before AS (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (
  SELECT *, coalesce(max(share) OVER (), 0) AS level FROM shared),
goals AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), w * level) AS target,
         CAST('0x' || substr(md5('{SALT}|' || coalesce(source, '')), 1, 8) AS BIGINT)
           / CAST(4294967296 AS DOUBLE) AS shift
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.shift,
         CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id) - 1 AS place
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       size * CAST(floor((place + 1) * rate + shift) - floor(place * rate + shift) AS BIGINT) AS taken
FROM placed
"""
