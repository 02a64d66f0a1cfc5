"""Token ids in binary files of patched frame-of-reference blocks.

File: the magic ``PFR1``, blocks one after the other, the index, and a tail (offset of the index,
number of blocks, number of ids) of three unsigned 64-bit integers. The index holds each block's
start in bytes, so a reader can begin at any block. A block of up to ``BLOCK`` ids: ids (uint16),
width in bits (uint8), exceptions (uint16), minimum (uint32); then ``id - minimum`` packed at that
width, the exceptions' places (uint16) and their full differences (uint32). The width is the one the
``PERCENTILE`` of the block needs; a wider difference is an exception and packs as zero. All integers
are little-endian.

Documents are range-partitioned by doc_id; each partition is one file, written block by block under a
fresh name. The manifest, a Spark table of (file, part, documents), names the files that count, so
files of failed or repeated attempts are ignored. Null text is the empty text (its end id only); rows
with equal ids stand next to each other in text order. Empty input gives no file and an empty result.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waitspark.llm.common import binary_texts, text_or_empty
from waitspark.workspace import materialize, scratch_path

MAGIC = b"PFR1"
BLOCK = 4096
PERCENTILE = 95
END_ID = 1
HEAD = struct.Struct("<HBHI")
TAIL = struct.Struct("<QQQ")
#: Chunks of text in a generation of what a worker remembers; it keeps two.
CACHE = 600_000
#: Patterns of tokenizers that part a sign from a letter before it, the signs, and a letter of two bytes.
LETTERS_APART = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)
SIGNS = (b".", b",", b";", b":", b"!", b"?")
LETTER = re.compile(rb"\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]")
#: Words that normalising leaves as they are and that no pattern parts.
SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: The letter that stands for a byte, where it is not the one of that number.
BYTE_LEVEL = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}
#: Stands between chunks encoded together; chunks that hold it are encoded alone.
FENCE = b"|"


def pack(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    used = values.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : (width + 7) // 8]
    bits = np.unpackbits(used, axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, dtype=np.uint32)
    bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8), bitorder="little")[: n * width].reshape(n, width)
    whole = np.zeros((n, 32), dtype=np.uint8)
    whole[:, :width] = bits
    return np.packbits(whole, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(ids: np.ndarray) -> bytes:
    least = int(ids.min())
    rest = (ids - np.uint32(least)).astype(np.uint32)
    place = -(-PERCENTILE * (len(rest) - 1) // 100)
    width = int(np.partition(rest, place)[place]).bit_length()
    wide = np.flatnonzero(rest >> np.uint64(width) if width < 32 else np.zeros(len(rest)))
    outliers = rest[wide]
    packed = rest.copy()
    packed[wide] = 0
    return (
        HEAD.pack(len(ids), width, len(wide), least)
        + pack(packed, width)
        + wide.astype("<u2").tobytes()
        + outliers.astype("<u4").tobytes()
    )


def decode_block(data: bytes) -> np.ndarray:
    n, width, exceptions, least = HEAD.unpack_from(data)
    at = HEAD.size
    end = at + (n * width + 7) // 8
    ids = unpack(data[at:end], width, n)
    places = np.frombuffer(data, "<u2", exceptions, end)
    ids[places] = np.frombuffer(data, "<u4", exceptions, end + 2 * exceptions)
    return ids + np.uint32(least)


class BlockWriter:
    """Takes ids as they come and writes full blocks; ``close`` writes the rest and the index."""

    def __init__(self, out) -> None:
        self.out, self.starts, self.at, self.total = out, [], 0, 0
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= 16 * BLOCK:
            self._flush(self.held // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        for i in range(0, n, BLOCK):
            self.starts.append(self.at)
            self._write(encode_block(ids[i : min(i + BLOCK, n)]))
        self.total += n
        self.waiting, self.held = [ids[n:]], len(ids) - n

    def close(self) -> None:
        self._flush(self.held)
        index = self.at
        self._write(np.array(self.starts, dtype="<u8").tobytes())
        self._write(TAIL.pack(index, len(self.starts), self.total))


class BlockReader:
    """Random access by block: ``ids(first, last)`` decodes only the blocks that hold them."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        if source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of token blocks")
        index, blocks, self.total = TAIL.unpack(source.read_at(TAIL.size, size - TAIL.size))
        starts = np.frombuffer(source.read_at(8 * blocks, index), dtype="<u8").astype(np.int64)
        self.bounds = np.append(starts, index)

    def block(self, i: int) -> np.ndarray:
        start, end = int(self.bounds[i]), int(self.bounds[i + 1])
        return decode_block(self.source.read_at(end - start, start))

    def ids(self, first: int, last: int) -> np.ndarray:
        if last <= first:
            return np.zeros(0, np.uint32)
        parts = [self.block(i) for i in range(first // BLOCK, (last - 1) // BLOCK + 1)]
        skip = first // BLOCK * BLOCK
        return np.concatenate(parts)[first - skip : last - skip]

    def stream(self) -> Iterator[np.ndarray]:
        for i in range(len(self.bounds) - 1):
            yield self.block(i)


def _steps(rule: dict | None, name: str) -> list[dict]:
    """A tokenizer's rule as a list: a sequence's own rules, or the one."""
    if rule is None:
        return []
    return rule[name] if rule["type"] == "Sequence" else [rule]


class ChunkEncoder:
    """A tokenizer that drops white space, applied chunk by chunk.

    No token and no normalisation of the tokenizer reaches over ASCII white space, so the ids of a
    text are those of its chunks in order; chunks already seen are looked up. A new chunk is looked up
    without its last sign, too, if the tokenizer always parts that sign from the letter before, and in small
    letters, if the tokenizer lowers them, so of chunks that differ in nothing else one is encoded. Words of small
    letters, which the tokenizer's rules leave as they are, go to its model at once.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fence = int(self._ids([FENCE])[0])
        rules = json.loads(Path(path).read_bytes())
        self.lowers = any(r["type"] == "Lowercase" for r in _steps(rules["normalizer"], "normalizers"))
        first = _steps(rules["pre_tokenizer"], "pretokenizers")[:1]
        parts = any(r["type"] == "Split" and r["pattern"].get("Regex") in LETTERS_APART for r in first)
        self.signs = {s: self._ids([s]).tobytes() for s in (SIGNS if parts else ())}
        last = _steps(rules["pre_tokenizer"], "pretokenizers")[1:]
        spelt = [r["type"] == "ByteLevel" and not r["add_prefix_space"] and not r["use_regex"] for r in last] == [True]
        others = [r for r in _steps(rules["normalizer"], "normalizers") if r["type"] not in ("NFC", "Lowercase")]
        blank = all(r["type"] == "Replace" and r["pattern"] == {"Regex": r"\s+"} for r in others)
        #: The tokenizer's model, if small letters reach it as they are.
        self.model = self.tokenizer.model if parts and spelt and blank else None
        #: Ids of chunks as bytes; ``old`` are those of the generation before.
        self.known: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        chunks = text.split()
        parts = list(map(self.known.get, chunks))
        new = [c for c, ids in zip(chunks, parts) if ids is None]
        if new:
            self._learn(dict.fromkeys(new))
            learnt = map(self.known.__getitem__, new)
            parts = [next(learnt) if ids is None else ids for ids in parts]
        return np.frombuffer(b"".join(parts), dtype="<u4")

    def _learn(self, chunks: dict[bytes, None]) -> None:
        """Remember ``chunks``, none of which is known."""
        if len(self.known) > CACHE:
            self.known, self.old = {}, self.known
        plain, derived = {}, []
        for c in chunks:
            if (ids := self.old.get(c)) is not None:
                self.known[c] = ids
            elif FENCE in c:
                self.known[c] = self._ids([c]).tobytes()
            else:
                word, sign = self._parted(c)
                if word != c:
                    derived.append((c, word, sign))
                if word in self.known:
                    continue
                if self.model is not None and SMALL.fullmatch(word):
                    spelt = word.decode("latin-1").translate(BYTE_LEVEL)
                    ids = [t.id for t in self.model.tokenize(spelt)]
                    self.known[word] = struct.pack(f"<{len(ids)}I", *ids)
                else:
                    plain[word] = None
        plain = list(plain)
        for i in range(0, len(plain), 500):
            self._learn_plain(plain[i : i + 500])
        for c, word, sign in derived:
            self.known[c] = self.known[word] + sign

    def _parted(self, chunk: bytes) -> tuple[bytes, bytes]:
        """A chunk that has the same ids but for the last sign's, and those."""
        # Small letters of others may compose where capital ones do not.
        word = chunk.lower() if self.lowers and chunk.isascii() else chunk
        ids = self.signs.get(word[-1:])
        if ids is None or not (word[-2:-1].isalpha() or LETTER.match(word[-3:-1])):
            return word, b""
        return word[:-1], ids

    def _ids(self, chunks: list[bytes]) -> np.ndarray:
        """Ids of some chunks, one after the other."""
        found = self.tokenizer.encode_batch_fast([b" ".join(chunks).decode()], add_special_tokens=False)
        return np.array(found[0].ids, dtype="<u4")

    def _learn_plain(self, chunks: list[bytes]) -> None:
        """Encode chunks in one call, with a fence between them that shows in the ids where each ends."""
        fenced = [FENCE] * (2 * len(chunks) - 1)
        fenced[::2] = chunks
        ids = self._ids(fenced)
        ends = np.append(np.flatnonzero(ids == self.fence), len(ids))
        if len(ends) != len(chunks):
            raise ValueError("the fence is not a token of its own in this tokenizer")
        data = ids.tobytes()
        start = 0
        for chunk, end in zip(chunks, (4 * ends).tolist()):
            self.known[chunk] = data[start:end]
            start = end + 4


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """One encoder, with what it remembers, for all tasks of a worker."""
    return ChunkEncoder(path)


def write_tokens(docs: DataFrame, encode: Callable[[], Callable[[bytes], np.ndarray]], end_id: int = END_ID) -> DataFrame:
    """Write the ids of ``docs`` in ascending doc_id order; the manifest as a table.

    ``encode`` makes a task's encoder. Manifest: part (ascending with doc_id), file, and the tokens of
    each document in order, ``docs`` as (doc_id, n_tokens).
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "tokens")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    rows = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_last())
    rows = rows.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        writer = encoder = out = name = None
        done = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), binary_texts(batch.column(1))):
                if writer is None:
                    encoder = encode()
                    store, root = fs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"part-{part:06d}-{uuid.uuid4().hex}.pfr"
                    out = store.open_output_stream(f"{root}/{name}")
                    writer = BlockWriter(out)
                ids = np.append(encoder(text), np.uint32(end_id))
                writer.add(ids)
                done.append((doc_id, len(ids)))
        if writer is not None:
            writer.close()
            out.close()
            for seq in range(0, len(done), 10_000):
                piece = done[seq : seq + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(piece), pa.int64()),
                        pa.array([f"{folder}/{name}"] * len(piece)),
                        pa.array(range(seq, seq + len(piece)), pa.int64()),
                        pa.array([d for d, _ in piece], pa.int64()),
                        pa.array([n for _, n in piece], pa.int64()),
                    ],
                    names=["part", "file", "seq", "doc_id", "n_tokens"],
                )

    return materialize(rows.mapInArrow(run, "part long, file string, seq long, doc_id long, n_tokens long"), "manifest")


def read_tokens(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: what the files hold, file by file, in document order."""
    totals = manifest.groupBy("part", "file").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: the running sum over them is the only step that sees all files at once.
    bases = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))
    rows = manifest.join(bases, "part").repartition(F.col("part")).sortWithinPartitions("part", "seq")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = blocks = None
        current, at = None, 0
        left = np.zeros(0, np.uint32)
        for batch in batches:
            start, n_tokens, crcs = [], [], []
            for part, file, n, base in zip(*(batch.column(c).to_pylist() for c in ("part", "file", "n_tokens", "base"))):
                if file != current:
                    store, path = fs.FileSystem.from_uri(file)
                    reader = BlockReader(store.open_input_file(path))
                    blocks, current, at, left = reader.stream(), file, 0, np.zeros(0, np.uint32)
                held, have = [left], len(left)
                while have < n:
                    held.append(next(blocks))
                    have += len(held[-1])
                joined = np.concatenate(held) if len(held) > 1 else left
                ids, left = joined[:n], joined[n:]
                start.append(base + at)
                n_tokens.append(len(ids))
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(start, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return read_tokens(write_tokens(docs, lambda: chunk_encoder(tokenizer)))
