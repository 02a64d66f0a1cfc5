"""What the operators on training text share: readers, word patterns, hashes, bounded samples."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    A cluster without a common file system is given the package with ``--py-files`` as usual.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_names(taken: Iterable[str], *names: str) -> list[str]:
    """``names`` with underscores added until none is in ``taken``, in any case of letters."""
    known = {t.lower() for t in taken}
    found = []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        found.append(name)
    return found


def fold(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % mod


def binary_texts(column: pa.ChunkedArray | pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, null as empty."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def words_lower(text: bytes) -> list[bytes]:
    """Words with A-Z lowered: bytes.lower and bytes.split know ASCII only, as the contracts ask."""
    return text.lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """xxhash64 of words, kept up to a bound so that a task's memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        value = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def hashed(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, those of the smallest hash of ``key``: the same ones on every run."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)
