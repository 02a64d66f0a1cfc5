"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every row gets the sha256 of its normalised text and a short fingerprint from it. The narrow
   table is written once.
2. A task codes the fingerprints it holds, at most ``LIST_ROWS`` at a time, before anything is shuffled:
   one list for each owner (a range of fingerprints), its distinct fingerprints sorted and coded as
   Golomb-Rice gaps. Fingerprints are cut to log2(rows) + EXTRA_BITS bits: enough that few differ
   only beyond the cut, short enough to be cheap to send. The lists are written with the rows they stand
   for; owners read and shuffle the codes only.
3. An owner decodes what it got, finds fingerprints that more than one list has (or one list has
   twice), and answers each list with a bitmap over it.
4. Rows whose bit is set are suspects. Their whole texts are shuffled and grouped byte by byte.
   The tasks that read the texts pick them by a Bloom filter of the suspects' digests, so the other texts
   stay where they are, but for the filter's false positives.

Grouping by the text combines copies in the tasks first, so a text that a third of the rows hold
costs each task one row. An owner sees a fingerprint at most once from each list.

Null text counts as empty, so null and empty texts are copies of each other. Of rows equal in text
and doc_id too, exactly one has ``kept``. Empty input gives an empty result. Other columns are
carried by ``deduplicate`` and ignored by ``classes``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.llm.bloom import bloom_filter, in_filter
from waitspark.llm.common import SPACE, free_names, text_or_empty
from waitspark.workspace import discard, materialize

EXTRA_BITS = 8
#: At least 2**OWNER_BITS owners.
OWNER_BITS = 4
#: Fingerprints an owner decodes, about.
OWNER_ROWS = 1_000_000
HASH_BITS = 60
#: Fingerprints a task codes at a time.
LIST_ROWS = 1 << 20
LISTS = "list_id long, owner long, n long, k int, unary binary, rest binary, twice binary, first binary, row_ids array<long>"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_or_empty(column), SPACE, " ")


def rice_encode(values: np.ndarray, k: int) -> tuple[bytes, bytes]:
    """Sorted distinct integers as gaps: unary quotients and ``k``-bit remainders."""
    gaps = np.diff(values, prepend=-1) - 1
    quotients = gaps >> k
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, dtype=np.uint8)
    unary[ends] = 1
    bits = (gaps[:, None] >> np.arange(k)) & 1
    return np.packbits(unary).tobytes(), np.packbits(bits.astype(np.uint8).ravel()).tobytes()


def rice_decode(unary: bytes, rest: bytes, k: int, n: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, dtype=np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, dtype=np.uint8))[: n * k].reshape(n, k).astype(np.int64)
    gaps = (quotients << k) + bits @ (1 << np.arange(k, dtype=np.int64))
    return np.cumsum(gaps + 1) - 1


def rice_width(n: int, span: int) -> int:
    """The Golomb parameter as a power of two: about ln 2 times the mean gap."""
    return max(0, math.floor(math.log2(max(1.0, math.log(2) * span / max(1, n)))))


def coded_lists(row_ids: np.ndarray, fps: np.ndarray, owner_bits: int) -> Iterator[tuple]:
    """A row of ``LISTS`` for each owner; ``first`` marks rows that begin a new fingerprint of the list."""
    order = np.argsort(fps, kind="stable")
    row_ids, fps = row_ids[order], fps[order]
    owners, starts = np.unique(fps >> owner_bits, return_index=True)
    for owner, ids, own in zip(owners, np.split(row_ids, starts[1:]), np.split(fps, starts[1:])):
        first = np.diff(own, prepend=-1) > 0
        values = own[first]
        counts = np.diff(np.append(np.flatnonzero(first), len(own)))
        k = rice_width(len(values), 1 << owner_bits)
        unary, rest = rice_encode(values & ((1 << owner_bits) - 1), k)
        yield int(ids.min()), int(owner), len(values), k, unary, rest, np.packbits(counts > 1).tobytes(), np.packbits(first).tobytes(), ids


def _code(owner_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= LIST_ROWS:
                yield from coded(held)
                held, rows = [], 0
        if rows:
            yield from coded(held)

    def coded(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        names = [part.split()[0] for part in LISTS.split(", ")]
        types = [pa.int64()] * 3 + [pa.int32()] + [pa.binary()] * 4 + [pa.list_(pa.int64())]
        for row in coded_lists(table.column(0).to_numpy(), table.column(1).to_numpy(), owner_bits):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return run


def _answer(rows: pd.DataFrame) -> pd.DataFrame:
    lists = [rice_decode(r.unary, r.rest, r.k, r.n) for r in rows.itertuples()]
    twice = [np.unpackbits(np.frombuffer(r.twice, dtype=np.uint8))[: r.n] for r in rows.itertuples()]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    shared = values[counts > 1]
    bitmaps = [np.packbits(np.isin(x, shared, assume_unique=True) | (t > 0)).tobytes() for x, t in zip(lists, twice)]
    return pd.DataFrame({"list_id": rows["list_id"], "bitmap": bitmaps})


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """row_id of a list's rows (bitmap, first, row_ids) whose fingerprint has its bit set."""
    for batch in batches:
        for bitmap, first, ids in zip(batch.column(0), batch.column(1), batch.column(2)):
            ids = ids.values.to_numpy()
            place = np.cumsum(np.unpackbits(np.frombuffer(first.as_py(), dtype=np.uint8))[: len(ids)], dtype=np.int64) - 1
            bits = np.unpackbits(np.frombuffer(bitmap.as_py(), dtype=np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array(ids[bits[place] > 0])], names=["row_id"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """row_id, doc_id and text_sha256, written once; later steps read this copy."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id"),
        F.sha2(normalised(), 256).alias("text_sha256"),
    )
    return materialize(rows, "fingerprints")


def suspects(rows: DataFrame) -> DataFrame:
    """row_id of the rows whose short fingerprint occurs more than once."""
    n = max(2, rows.count())
    owner_count_bits = max(OWNER_BITS, math.ceil(math.log2(n / OWNER_ROWS)))
    bits = min(HASH_BITS, max(owner_count_bits, math.ceil(math.log2(n))) + EXTRA_BITS)
    owner_bits = bits - owner_count_bits
    long_hash = F.conv(F.substring("text_sha256", 1, HASH_BITS // 4), 16, 10).cast("long")
    short = rows.select("row_id", F.shiftright(long_hash, HASH_BITS - bits).alias("fp"))
    lists = materialize(short.mapInArrow(_code(owner_bits), LISTS), "lists")
    answers = lists.drop("first", "row_ids").groupBy("owner").applyInPandas(_answer, "list_id long, bitmap binary")
    found = lists.select("list_id", "first", "row_ids").join(answers, "list_id")
    found = materialize(found.select("bitmap", "first", "row_ids").mapInArrow(_suspects, "row_id long"), "suspects")
    discard(lists)
    return found


def classes(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, text_sha256, keep_id, group_size and kept, one row per row of ``docs``."""
    rows = fingerprints(docs)
    found = suspects(rows)
    flagged = materialize(rows.join(found.withColumn("suspect", F.lit(True)), "row_id", "left"), "flagged")
    discard(rows, found)
    suspect = flagged.filter("suspect").drop("suspect")
    groups = materialize(byte_groups(docs, suspect), "text-groups")
    alone = flagged.filter("suspect IS NULL").select(
        "row_id",
        "doc_id",
        "text_sha256",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    copies = suspect.join(groups, "text_sha256").select(
        "row_id", "doc_id", "text_sha256", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept")
    )
    return alone.unionByName(copies)


def byte_groups(docs: DataFrame, suspect: DataFrame) -> DataFrame:
    """A row per text of the suspects: digest, smallest doc_id with its row, number of rows.

    The tasks pick the suspects' texts by the filter and group them as whole strings; what else passed
    the filter falls out with the digests. Two texts of one digest are refused: a digest could no
    longer stand for its text.
    """
    texts = suspect_texts(docs, bloom_filter(suspect, "text_sha256")).distinct()
    verified = texts.groupBy("text_sha256").agg(F.count("*").alias("texts"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row_id")))
    sizes = suspect.groupBy("text_sha256").agg(least.alias("least"), F.count("*").alias("group_size"))
    one = F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
        F.raise_error(F.lit("two texts share a sha256")).cast("long")
    )
    return sizes.join(verified, "text_sha256").select(
        "text_sha256",
        F.col("least.doc_id").alias("keep_id"),
        F.col("least.row_id").alias("keep_row"),
        one.alias("group_size"),
    )


def suspect_texts(docs: DataFrame, bloom: DataFrame) -> DataFrame:
    """(text_sha256, text) of the rows of ``docs`` that the filter may hold."""
    texts = docs.select(normalised().alias("text")).withColumn("text_sha256", F.sha2("text", 256))
    return in_filter(texts.select("text_sha256", "text"), bloom, "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text, that of the smallest doc_id, and all its columns.

    Rows of whose text nothing is dropped pass as they are, without a shuffle. Of the others, told by a filter
    of the dropped digests, the row that stays is fetched by (doc_id, digest); of rows equal in both, any
    one stays.
    """
    found = materialize(classes(docs), "classes")
    sha, own, digest, other, second = free_names([*docs.columns, "doc_id"], "_sha", "_id", "_digest", "_i", "_d")
    stay = found.filter("kept AND group_size > 1").select(F.col("doc_id").alias(own), F.col("text_sha256").alias(digest))
    keyed = docs.withColumn(sha, F.sha2(normalised(), 256))
    bloom = bloom_filter(found.filter("NOT kept"), "text_sha256")
    others, keyed = in_filter(keyed, bloom, sha, inside=False), in_filter(keyed, bloom, sha)
    dropped = found.filter("NOT kept").select(F.col("doc_id").alias(own), F.col("text_sha256").alias(digest)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(own)) & (F.col(sha) == F.col(digest))
    rest = keyed.join(dropped, same, "left_anti")
    # A repeated row is both dropped and kept: one of its twins comes back.
    again = dropped.withColumnsRenamed({own: other, digest: second})
    twins = stay.join(again, F.col(own).eqNullSafe(F.col(other)) & (F.col(digest) == F.col(second)), "left_semi")
    back = keyed.join(twins, same, "left_semi").dropDuplicates(["doc_id", sha])
    return others.unionByName(rest).unionByName(back).select(*docs.columns)


def op4(docs: DataFrame) -> DataFrame:
    return classes(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = """
WITH digests AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS text_sha256
  FROM documents),
ranked AS (
  SELECT *, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) AS place
  FROM digests)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked
"""
