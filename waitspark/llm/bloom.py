"""A Bloom filter as a small table, applied by a broadcast join inside the tasks that read the rows.

It has at most ``SLOTS`` words of 64 bits, so its size is bounded whatever it holds, and a value sets
``SLOT_BITS`` bits of one word. With more than a few million different values it fills up and lets more rows
pass that it does not hold; it never loses one it holds. Callers decide exactly on what passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.llm.common import free_names
from waitspark.workspace import materialize

SLOTS = 1 << 20
SLOT_BITS = 4


def bloom_filter(rows: DataFrame, column: str) -> DataFrame:
    """(_slot, _word) of the values of ``column``, written once. No rows give an empty filter."""
    slot, bits = _slot_and_bits(column)
    words = rows.select(slot.alias("_slot"), bits.alias("_bits")).groupBy("_slot").agg(F.bit_or("_bits").alias("_word"))
    return materialize(words, "bloom")


def in_filter(rows: DataFrame, bloom: DataFrame, column: str, inside: bool = True) -> DataFrame:
    """``rows`` whose ``column`` the filter may hold, or with ``inside`` false those it surely does not."""
    slot, bits = _slot_and_bits(column)
    slots, words = free_names(rows.columns, "_slot", "_word")
    named = F.broadcast(bloom.select(F.col("_slot").alias(slots), F.col("_word").alias(words)))
    held = (slot == F.col(slots)) & (F.col(words).bitwiseAND(bits) == bits)
    return rows.join(named, held, "left_semi" if inside else "left_anti")


def _slot_and_bits(column: str) -> tuple[Column, Column]:
    """Of a value: its word of the filter, and the bits it sets there."""
    h = F.xxhash64(F.col(column))
    bits = F.lit(0).cast("long")
    for i in range(SLOT_BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return F.shiftrightunsigned(h, 64 - SLOTS.bit_length() + 1), bits
