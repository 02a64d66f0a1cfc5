"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

A text is encoded match by match of the splitting pattern, without special tokens. Texts of more than
``LONG`` characters are first cut where a match must end whatever stands around it: before white space
that follows a printable ASCII character. No alternative of the pattern goes from another character to
white space, and none looks back, so the ids of the parts in order are those of the whole text. A run
of more than ``RUN`` white space characters, which the library's matcher has no stack for, is encoded
by the rule that the pattern states for it: all but the last character before other text, or all at
the end of the text, are one match.

Decoding joins the bytes of the ids, so ids that end inside a character decode too. Null is the empty
text; empty text has no ids and decodes to no bytes. Repeated rows are encoded alike; an empty table
stays empty; other columns are carried along, but those named like a result are replaced.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitspark.llm.common import text_or_empty

#: Characters of a text that is encoded in one call, and of the parts of longer ones.
LONG = 16_384
#: Rows whose results a task holds at a time.
TOGETHER = 500
#: White space characters that the library's matcher takes in one run.
RUN = 1_024
#: The characters with the Unicode property White_Space.
WHITE = (
    "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LONG_RUN = re.compile(f"[{WHITE}]{{{RUN},}}")
SAFE = re.compile(r"(?<=[!-~])(?=[ \n])")


def load_ranks(lines: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from the lines of a rank file: base64, space, number."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """``text`` cut at safe places; True marks a part that is one match of white space."""
    at = 0
    for run in LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from ((part, False) for part in _cut(text, at, run.start()))
        yield text[run.start() : end], True
        at = end
    yield from ((part, False) for part in _cut(text, at, len(text)))


def _cut(text: str, at: int, end: int) -> Iterator[str]:
    while end - at > LONG:
        safe = SAFE.search(text, at + LONG, end)
        if safe is None:
            break
        yield text[at : safe.start()]
        at = safe.start()
    if at < end:
        yield text[at:end]


class Codec:
    def __init__(self, lines: bytes, pattern: str) -> None:
        import tiktoken

        ranks = load_ranks(lines)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the rank file has no token for the bytes {missing[:5]}")
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tokens = {rank: token for token, rank in ranks.items()}

    def encode(self, text: str) -> np.ndarray:
        if len(text) <= LONG:
            found = self.encoding.encode_ordinary(text) if len(text) < RUN or not LONG_RUN.search(text) else self._long(text)
        else:
            found = self._long(text)
        return np.array(found, dtype="<u4")

    def _long(self, text: str) -> list[int]:
        one, many = self.encoding._encode_single_piece, self.encoding.encode_ordinary
        return list(chain.from_iterable(one(part.encode()) if single else many(part) for part, single in parts(text)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(lines: bytes, pattern: str) -> Codec:
    """One codec for all tasks of a worker."""
    return Codec(lines, pattern)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _shared(df: DataFrame, rank_file: str | None):
    """The lines of the rank file, as large as the vocabulary, for all workers."""
    with open(rank_file or default_ranks(), "rb") as lines:
        return df.sparkSession.sparkContext.broadcast(lines.read())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``TOGETHER`` rows, so that a task holds the results of a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(start, TOGETHER)


def encode(
    docs: DataFrame,
    rank_file: str | None = None,
    pattern: str | None = None,
    text: str = "text",
    carry: list[str] | None = None,
    packed: bool = False,
) -> DataFrame:
    """``carry`` (all columns if None) with ``ids`` and ``n_tokens``.

    ``ids`` is an array of int; packed, the ids as little-endian unsigned 32-bit integers in one binary.
    """
    lines, pattern = _shared(docs, rank_file), pattern or default_pattern()
    kept = [c for c in (docs.columns if carry is None else carry) if c not in ("ids", "n_tokens")]
    held = "_text"
    while held in kept:
        held += "_"
    rows = docs.select(*kept, text_or_empty(text).alias(held))
    ids_type = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    schema = T.StructType(
        [*docs.select(*kept).schema.fields, T.StructField("ids", ids_type, False), T.StructField("n_tokens", T.LongType(), False)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(lines.value, pattern)
        for batch in _slices(batches):
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            found = [bpe.encode(value.as_py().decode(errors="replace")) for value in texts]
            sizes = [len(ids) for ids in found]
            if packed:
                ids = pa.array([x.tobytes() for x in found], pa.binary())
            else:
                values = np.concatenate(found).view(np.int32) if found else np.zeros(0, np.int32)
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids, pa.array(sizes, pa.int64())], names=[*kept, "ids", "n_tokens"])

    return rows.mapInArrow(run, schema)


def decode(
    encoded: DataFrame, rank_file: str | None = None, pattern: str | None = None, ids: str = "ids", into: str = "decoded"
) -> DataFrame:
    """``encoded`` with the bytes of its ids (array or packed) in binary column ``into``; null ids give null."""
    lines, pattern = _shared(encoded, rank_file), pattern or default_pattern()
    kept = [c for c in encoded.columns if c != into]
    place = kept.index(ids)
    schema = T.StructType([*encoded.select(*kept).schema.fields, T.StructField(into, T.BinaryType(), True)])

    def numbers(value: pa.Scalar) -> list[int] | None:
        plain = value.as_py()
        return np.frombuffer(plain, "<u4").tolist() if isinstance(plain, bytes) else plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(lines.value, pattern)
        for batch in _slices(batches):
            found = [None if x is None else bpe.decode(x) for x in map(numbers, batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.binary())], names=[*kept, into])

    return encoded.select(*kept).mapInArrow(run, schema)


def op13(docs: DataFrame, rank_file: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to."""
    coded = decode(encode(docs, rank_file, carry=["doc_id"], packed=True), rank_file)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
