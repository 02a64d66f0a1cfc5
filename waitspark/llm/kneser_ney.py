"""Counting, joining and looking up word n-grams for Kneser-Ney models.

N-grams are named by 64-bit hashes chained from left to right. A model stays in shards by the middle word
of a trigram, which hold what all its shorter forms need too. Scoring deals the trigrams of the texts to the shards, looks them up there and
sums by text. On the way and at rest trigrams are packed: frequent words as short codes, others by name. Two things of fixed size go to the
tasks: those codes, and a filter of the words that the model holds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import cached_property, reduce
from itertools import groupby
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from waitspark.llm.common import WordHashes, binary_texts, hashed, mix64, words_lower
from waitspark.workspace import discard, materialize, shuffles_freed

if TYPE_CHECKING:
    import pandas as pd

#: Names the place before the first word, and the one after the last.
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)
#: 64-bit words of the filter that tells which words the model may hold, and its slices.
FILTER_WORDS, FILTER_SLICES = 1 << 20, 16
#: So many words, the most frequent ones, have codes, which are sent to the tasks.
WORD_ROWS = 1 << 18
#: Places of texts that a task works on at once, and bytes of texts that it splits at once, about.
PLACES = 1 << 18
SLICE_BYTES = 1 << 21
#: Rows that Spark hands to Python at once: texts and blobs are long.
ROWS_AT_ONCE = 400
_STEP = np.uint64(0x9E3779B97F4A7C15)


def chain(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The name of an n-gram from the name of its first n-1 words and its last word."""
    return mix64(left * _STEP + word)


def text_hashes(text: bytes, cache: WordHashes) -> np.ndarray:
    return hashed(words_lower(text), cache)


#: Names of the contexts before the first word.
EDGES = np.append(START, chain(np.array([START]), np.array([START])))


def shifted(h: np.ndarray, by: int) -> np.ndarray:
    """Each place's word ``by`` places earlier."""
    return np.concatenate([np.full(min(by, len(h)), START), h[: max(0, len(h) - by)]])


def names(h: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1..order, the names of the n-grams that end at each word."""
    found = []
    for n in range(1, order + 1):
        name = shifted(h, n - 1)
        for k in range(n - 2, -1, -1):
            name = chain(name, shifted(h, k))
        found.append(name)
    return found


def ngram_rows(texts: DataFrame, order: int, carry: list[str] | None = None) -> DataFrame:
    """A row per word of the column ``text``: ``carry``, and g1..g<order>, c2..c<order>.

    g<n> names the n-gram ending at the word; c<n> names the n-1 words before it, its context.
    """
    carry = carry or []
    rows = texts.select(*carry, "text")
    numbers = [f"g{n}" for n in range(1, order + 1)] + [f"c{n}" for n in range(2, order + 1)]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]] + [f"{c} long" for c in numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            kept = [batch.column(i).to_pylist() for i in range(len(carry))]
            for i, text in enumerate(binary_texts(batch.column(len(carry)))):
                h = text_hashes(text, cache)
                grams = names(h, order)
                contexts = [before(h, n) for n in range(1, order)]
                for at in range(0, len(h), 100_000):
                    part = slice(at, at + 100_000)
                    columns = [pa.array([k[i]] * len(h[part]), batch.schema.field(j).type) for j, k in enumerate(kept)]
                    columns += [pa.array(x[part].view(np.int64)) for x in (*grams, *contexts)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*carry, *numbers])

    return rows.mapInArrow(run, schema)


def before(h: np.ndarray, n: int) -> np.ndarray:
    """Names of the ``n`` words before each place."""
    name = shifted(h, n)
    for k in range(n - 1, 0, -1):
        name = chain(name, shifted(h, k))
    return name


@dataclass
class Table:
    """Sorted 64-bit names with a float of each; looked up by leading bits, then by steps."""

    keys: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    shift: int
    longest: int

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        order = np.argsort(keys, kind="stable")
        keys, values = keys[order], values[order]
        bits = max(1, int(len(keys)).bit_length())
        heads = (keys >> np.uint64(64 - bits)).astype(np.int64)
        starts = np.searchsorted(heads, np.arange((1 << bits) + 1)).astype(np.int32)
        longest = int(np.diff(starts).max(initial=0))
        # A sentinel after the end, so that a step past the last key needs no test.
        return cls(np.append(keys, np.uint64(0)), np.append(values, 0).astype(np.float32), starts, 64 - bits, longest)

    def places(self, names: np.ndarray) -> np.ndarray:
        """Where each name is; the place after the last key if it is none."""
        out = np.full(len(names), len(self.keys) - 1)
        if len(self.keys) == 1 or not len(names):
            return out
        head = (names >> np.uint64(self.shift)).astype(np.int64)
        at, end = self.starts[head], self.starts[head + 1]
        open_ = np.flatnonzero(at < end)
        for _ in range(self.longest):
            if not len(open_):
                break
            places = at[open_]
            hit = self.keys[places] == names[open_]
            out[open_[hit]] = places[hit]
            at[open_] += 1
            open_ = open_[~hit]
            open_ = open_[at[open_] < end[open_]]
        return out

    def get(self, names: np.ndarray, default: float = 0.0) -> np.ndarray:
        at = self.places(names)
        return np.where(at == len(self.keys) - 1, default, self.values[at].astype(np.float64))


def discounts(count_of_counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from how many n-grams have counts 1 to 4."""
    n1, n2, n3, n4 = (count_of_counts.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), i - 0.05) for i, d in enumerate((d1, d2, d3), 1))


def discount(count: Column, d: tuple[float, float, float]) -> Column:
    return F.when(count == 1, d[0]).when(count == 2, d[1]).otherwise(F.when(count > 2, d[2]).otherwise(0.0))


def to_table(df: DataFrame, key: str, value: str) -> Table:
    """A bounded result as a lookup table."""
    got = df.select(F.col(key).cast("long"), F.col(value).cast("double")).toArrow()
    return Table.of(got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy())


#: Codes of words in blobs: a word that the model does not know, the two edges, then the most frequent words.
UNKNOWN_CODE, START_CODE, END_CODE, FIRST_CODE = 0, 1, 2, 3
#: Trigrams of trusted text that a shard holds, about.
SHARD_ROWS = 1 << 18
#: A middle word that stands more often is dealt over several shards, by the word before it.
SPLIT_ROWS = 1 << 18
#: Documents are scored against so many parts of the model, one after the other.
PASSES = 4
#: Sums of so many texts, as a power of two, come back together.
BLOCK_BITS = 12
#: What a row of a shard holds.
TRIGRAMS, SINGLE, SPLIT, TEXTS, ABOUT = range(5)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob; integers byte by byte, as their upper bytes are mostly zero."""
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], np.int64)
    planes = [a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays)]
    data = head.tobytes() + b"".join(planes)
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unpack(blob: bytes, kinds: list[str]) -> list[np.ndarray]:
    data = pa.Codec("zstd").decompress(memoryview(blob)[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    at, found = 8 * (1 + 2 * len(kinds)), []
    for kind, (width, n) in zip(kinds, np.frombuffer(data, np.int64, 2 * len(kinds), 8).reshape(-1, 2).tolist()):
        planes = np.frombuffer(data, np.uint8, width * n, at).reshape(width, n)
        found.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += width * n
    return found


def pack_words(words: list[np.ndarray], names: np.ndarray, hot: int, *more: np.ndarray) -> bytes:
    """Columns of word numbers as codes, and the names of those that have none."""
    columns = []
    for w in words:
        columns += [np.minimum(w, hot).astype(np.uint32), names[w[w >= hot]]]
    return pack(*columns, *more)


def unpack_words(blob: bytes, names: np.ndarray, *more: str) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Codes and names of three columns of words, and the other columns. ``names`` are those of the codes."""
    found = unpack(blob, ["u4", "u8"] * 3 + list(more))
    codes, words = found[0:6:2], []
    for code, rest in zip(codes, found[1:6:2]):
        word = names[np.minimum(code, len(names) - 1)]
        word[code == len(names)] = rest
        words.append(word)
    return codes, words, found[6:]


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Texts some at a time: the first one's place, all their words with A-Z lowered (as ``words_lower``), and how many each has."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    for _, at in runs((np.cumsum(sizes, dtype=np.int64) - sizes) // SLICE_BYTES):
        first = int(at[0])
        lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(first, len(at))))
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten()
        # White space at the edges leaves empty words.
        full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
        upto = np.append(0, np.cumsum(full))[ends]
        yield first, words.filter(pa.array(full)), np.diff(upto)


@dataclass
class Shared:
    """What all tasks know of the words: names of codes, and how the trigrams around each are dealt."""

    names: np.ndarray
    codes: Table
    #: Over how many shards the trigrams around each code are dealt.
    parts: np.ndarray
    shards: int

    def numbers(self, words: pa.Array, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Words as codes, or numbers from there on, and the names of all numbers. With a filter, words that it does not hold are unknown."""
        found = words.dictionary_encode()
        names = names_of(found.dictionary)
        number = self.codes.get(names, -1).astype(np.int64)
        rest = number < 0
        if known is not None:
            word, mask = _bits(names)
            number[rest & (known[word] & mask != mask)] = UNKNOWN_CODE
            rest = number < 0
        number[rest] = len(self.names) + np.arange(rest.sum())
        return number[found.indices.to_numpy()], np.append(self.names, names[rest])

    def _homes(self, names: np.ndarray) -> np.ndarray:
        return (mix64(names + _STEP) % np.uint64(self.shards)).astype(np.int32)

    @cached_property
    def homes(self) -> np.ndarray:
        """Shards of the codes, as a task needs them again and again."""
        return self._homes(self.names)

    def shards_of(self, w1: np.ndarray, w2: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Of trigrams given by word numbers, by middle word."""
        found = np.append(self.homes, self._homes(names[len(self.names) :]))[w2]
        parts = np.where(w2 < len(self.parts), self.parts[np.minimum(w2, len(self.parts) - 1)], np.uint64(1))
        several = np.flatnonzero(parts > 1)
        if len(several):
            part = mix64(names[w1[several]]) % parts[several]
            found[several] = (mix64(names[w2[several]] + _STEP + part * _STEP) % np.uint64(self.shards)).astype(np.int32)
        return found

    def shards_of_word(self, code: int) -> list[int]:
        part = np.arange(int(self.parts[code]), dtype=np.uint64)
        return np.unique(mix64(self.names[code : code + 1] + _STEP + part * _STEP) % np.uint64(self.shards)).tolist()


def names_of(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words.cast(pa.binary()).to_numpy(zero_copy_only=False)), np.uint64, len(words))


def word_counts(texts: DataFrame) -> DataFrame:
    """key, c: the name of each word of the column ``text``, and how often it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, _ in slices(batch.column(0)):
                found = words.value_counts()
                names = pa.array(names_of(found.field("values")).view(np.int64))
                yield pa.RecordBatch.from_arrays([names, found.field("counts").cast(pa.int64())], names=["key", "n"])

    return texts.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("c"))


def numbered(words: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each word and end of texts of so many words, none of them empty: the text's place, the two words before it, and the word."""
    sizes = n_words + 3
    starts = np.cumsum(sizes) - sizes
    flat = np.full(sizes.sum(), START_CODE)
    inside = np.ones(len(flat), dtype=bool)
    inside[starts] = inside[starts + 1] = False
    at = np.flatnonzero(inside)
    flat[starts + sizes - 1] = END_CODE
    inside[starts + sizes - 1] = False
    flat[inside] = words
    return np.repeat(np.arange(len(sizes)), sizes - 2), flat[at - 2], flat[at - 1], flat[at]


def runs(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key, none below zero, with its places in order."""
    # Two bytes are sorted by counting.
    order = np.argsort(keys.astype(np.uint16) if keys.max(initial=0) < 1 << 16 else keys, kind="stable")
    found = keys[order]
    starts = np.flatnonzero(np.diff(found, prepend=-1))
    for at, end in zip(starts.tolist(), [*starts[1:].tolist(), len(found)]):
        yield int(found[at]), order[at:end]


def counted(texts: DataFrame, shared: Broadcast) -> DataFrame:
    """shard, kind, blob: the different trigrams of the column ``text``, a row per shard, and how often each stands.

    One shuffle, by the word in the middle: a trigram, the context of its first two words and the bigram
    of its last two all share that word, so every count but those of single words is local to its shard.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for _, words, n_words in slices(batch.column(0)):
                numbers, names = known.numbers(words)
                _, *words = numbered(numbers, n_words[n_words > 0])
                for i in range(0, len(words[0]), PLACES):
                    part = [w[i : i + PLACES] for w in words]
                    shards = runs(known.shards_of(part[0], part[1], names))
                    found = [(shard, pack_words([w[at] for w in part], names, len(known.names))) for shard, at in shards]
                    columns = [pa.array([s for s, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["shard", "blob"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value.names
        for shard, rows in by_shard(batches):
            found = [unpack_words(blob, names) for _, blob in rows]
            codes, words = ([np.concatenate([f[i][k] for f in found]) for k in range(3)] for i in range(2))
            name = chain(chain(words[0], words[1]), words[2])
            _, first, n = np.unique(name, return_index=True, return_counts=True)
            # In order of the middle word, then of the one before, they take less room.
            order = np.lexsort((words[0][first], words[1][first]))
            first, n = first[order], n[order]
            columns = []
            for code, word in zip(codes, words):
                kept = code[first]
                columns += [kept, word[first][kept == len(names)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([TRIGRAMS], pa.int8()), pa.array([pack(*columns, n.astype(np.uint32))], pa.binary())],
                names=["shard", "kind", "blob"],
            )

    dealt = texts.select("text").mapInArrow(deal, "shard int, blob binary")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(count, "shard int, kind byte, blob binary")


def by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows (shard, blob) of each shard; they come in order of shards."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, key=lambda r: r[0])


@dataclass
class Shard:
    """Aggregates over the trigrams of a shard; ``single`` and ``split`` as ``Model`` has them."""

    codes: list[np.ndarray]
    words: list[np.ndarray]
    n3: np.ndarray

    @classmethod
    def of(cls, blob: bytes, names: np.ndarray) -> Shard:
        codes, words, (n3,) = unpack_words(blob, names, "u4")
        return cls(codes, words, n3.astype(np.int64))

    @cached_property
    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Names of the different last two words, one place of each, of each trigram its bigram, different words before each."""
        return np.unique(chain(self.words[1], self.words[2]), return_index=True, return_inverse=True, return_counts=True)


def statistics(trigrams: DataFrame, shared: Broadcast) -> DataFrame:
    """what, key, other, shard, n: what other shards and the driver must know of each shard.

    words: key stands after n different words of the shard (words that are split left out); those without a code are
    listed with the shard that asks for their sum, also if they stand in the middle only. split: after ``other``, a word that is
    split, key stands in n trigrams. n3, n2: n trigrams, n bigrams of words that are not split, stand key times, 5 and more as 5.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def rows(what: str, key: np.ndarray, n: np.ndarray, other: np.ndarray | None = None, shard: int = -1) -> pa.RecordBatch:
            numbers = [x.astype(np.uint64).view(np.int64) for x in (key, np.zeros(len(key)) if other is None else other)]
            columns = [np.full(len(key), what), *numbers, np.full(len(key), shard, np.int32), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["what", "key", "other", "shard", "n"])

        for batch in batches:
            for shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = Shard.of(blob, known.names)
                yield rows("n3", *np.unique(np.minimum(own.n3, 5), return_counts=True))
                _, first, _, n2 = own.bigrams
                code2, code3, word2, word3 = own.codes[1][first], own.codes[2][first], own.words[1][first], own.words[2][first]
                several = np.append(known.parts, np.uint64(1))[code2] > 1
                yield rows("n2", *np.unique(np.minimum(n2[~several], 5), return_counts=True))
                yield rows("split", word3[several], n2[several], word2[several])
                hot = code3 < len(known.names)
                yield rows("words", *np.unique(word3[hot & ~several], return_counts=True))
                # Words without a code that follow or stand in the middle, as one list.
                asked = [word3[~hot & ~several], word3[~hot & several], word2[code2 == len(known.names)]]
                key, at = np.unique(np.concatenate(asked), return_inverse=True)
                yield rows("words", key, np.bincount(at[: len(asked[0])], minlength=len(key)), shard=shard)

    return trigrams.select("shard", "blob").mapInArrow(run, "what string, key long, other long, shard int, n long")


def packed(rows: DataFrame, kind: int, columns: list[str]) -> DataFrame:
    """shard, kind, blob of rows with a shard and numbers."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        import pandas as pd

        blob = pack(*[group[c].to_numpy().astype(np.int64) for c in columns])
        return pd.DataFrame({"shard": group["shard"][:1], "kind": [kind], "blob": [blob]})

    return rows.select("shard", *columns).groupBy("shard").applyInPandas(run, "shard int, kind byte, blob binary")


@dataclass
class Model:
    """An interpolated modified Kneser-Ney trigram model, in shards by the middle word of a trigram.

    ``rows`` (shard, kind, blob): trigrams with their counts; of words without a code, the different words before them where there are
    several; bigrams of a word that is split, in each of its shards.
    """

    rows: DataFrame
    shared: Shared
    #: Names of words the model holds, as a filter.
    known: np.ndarray
    #: Different words before each code.
    n1: np.ndarray
    discounts: tuple[tuple[float, float, float], ...]
    whole: float
    #: Probability of a word that the model does not know, before any other value.
    unknown: float
    #: Written tables behind ``rows``.
    tables: tuple[DataFrame, ...]

    def p1(self, n1: np.ndarray) -> np.ndarray:
        return (n1 - cut(n1, self.discounts[0])) / self.whole + self.unknown


def cut(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def train(texts: DataFrame, hot_words: int | None = None) -> Model:
    """A model of the column ``text``, each text closed by an end that counts as a word.

    Single words count the different words before them, as bigrams do; texts without words count nothing.
    ``hot_words`` words are named by short codes; what that is changes no result.
    """
    with shuffles_freed(texts.sparkSession, ROWS_AT_ONCE):
        return _train(texts, WORD_ROWS if hot_words is None else min(hot_words, WORD_ROWS))


def _train(texts: DataFrame, hot_words: int) -> Model:
    context = texts.sparkSession.sparkContext
    counts = materialize(word_counts(texts), "vocabulary")
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n")).first()["n"]
    frequent = counts.orderBy(F.desc("c"), "key").limit(hot_words).toArrow()
    codes = np.array([0x554E4B, int(START), int(END)], np.uint64)
    names = np.append(codes, frequent.column("key").to_numpy().view(np.uint64))
    parts = np.append(np.ones(FIRST_CODE, np.uint64), (1 + frequent.column("c").to_numpy() // SPLIT_ROWS).astype(np.uint64))
    place = Table.of(names[FIRST_CODE:], np.arange(FIRST_CODE, len(names)))
    shared = Shared(names, place, parts, 1 + total // SHARD_ROWS)
    sent = context.broadcast(shared)
    trigrams = materialize(counted(texts, sent), "trigrams")
    found = materialize(statistics(trigrams, sent), "trigram-statistics")
    split = found.filter("what = 'split'").groupBy("other", "key").agg(F.sum("n").alias("n"))
    split = materialize(split, "split-bigrams")
    ones = split.select("key", F.lit(1).cast("long").alias("n"))
    single = found.filter("what = 'words'").select("key", "n").unionByName(ones).groupBy("key").agg(F.sum("n").alias("n"))
    single = materialize(single.filter("n > 0"), "model-words")

    def kinds(rows: DataFrame) -> Counter:
        of = rows.groupBy(F.least("key", F.lit(5)).alias("key")).agg(F.sum("n").alias("n"))
        return Counter({r["key"]: r["n"] for r in of.collect()})

    one = F.lit(1).cast("long").alias("n")
    d3 = discounts(kinds(found.filter("what = 'n3'")))
    d2 = discounts(kinds(found.filter("what = 'n2'")) + kinds(split.select(F.col("n").alias("key"), one)))
    d1 = discounts(kinds(single.select(F.col("n").alias("key"), one)))
    size = single.agg(F.sum("n").alias("all"), F.sum(discount(F.col("n"), d1)).alias("cut"), F.count("*").alias("v")).first()
    whole = size["all"] or 1
    unknown = (size["cut"] / whole if size["v"] else 1.0) / (size["v"] + 1)

    n1 = np.zeros(len(names), np.int64)
    at = {int(name): i for i, name in enumerate(names)}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.sort(sent.value.names)
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(own[np.minimum(np.searchsorted(own, key), len(own) - 1)] == key))

    for r in single.mapInArrow(coded, single.schema).toLocalIterator():  # a row per code at most
        n1[at[r["key"] % 2**64]] = r["n"]
    holders = [(int(names[c].view(np.int64)), int(s)) for c in np.flatnonzero(parts > 1) for s in shared.shards_of_word(c)]
    holders = texts.sparkSession.createDataFrame(holders, "other long, shard int")
    spread = split.join(F.broadcast(holders), "other")
    asked = found.filter("what = 'words' AND shard >= 0").select("key", "shard").unionByName(spread.select("key", "shard"))
    asked = asked.distinct().join(single.filter("n > 1"), "key")
    more = packed(asked, SINGLE, ["key", "n"]).unionByName(packed(spread, SPLIT, ["other", "key", "n"]))
    more = materialize(more, "model-shards")
    known = key_filter(counts)
    discard(counts, found, split, single)
    sent.destroy()
    return Model(trigrams.unionByName(more), shared, known, n1, (d1, d2, d3), float(whole), unknown, (trigrams, more))


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key's word of the filter, by its leading bits, and its four bits there, by its last ones."""
    mask = np.zeros(len(keys), dtype=np.uint64)
    for i in range(4):
        mask |= np.uint64(1) << (keys >> np.uint64(6 * i) & np.uint64(63))
    return (keys >> np.uint64(64 - FILTER_WORDS.bit_length() + 1)).astype(np.int64), mask


def key_filter(rows: DataFrame) -> np.ndarray:
    """A filter of the column ``key``, of fixed size; more keys only mean more false hits. A task fills whole slices."""
    width = FILTER_WORDS // FILTER_SLICES
    part = F.shiftrightunsigned("key", 64 - FILTER_SLICES.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[int, np.ndarray] = {}
        for batch in batches:
            at, mask = _bits(batch.column(0).to_numpy().view(np.uint64))
            for i in np.unique(at // width).tolist():
                own = at // width == i
                np.bitwise_or.at(slices.setdefault(i, np.zeros(width, np.uint64)), at[own] % width, mask[own])
        for i, words in slices.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([words.tobytes()])], names=["slice", "bits"])

    filled = np.zeros(FILTER_WORDS, dtype=np.uint64)
    for r in rows.select("key").repartition(FILTER_SLICES, part).mapInArrow(run, "slice int, bits binary").toLocalIterator():
        filled[r["slice"] * width : (r["slice"] + 1) * width] |= np.frombuffer(r["bits"], np.uint64)
    return filled


@dataclass
class Values:
    """What trigrams of texts add in one shard, as logarithms: found by trigram, or by context and bigram, or by middle word."""

    trigrams: Table
    contexts: Table
    bigrams: Table
    middles: Table
    #: Of words without a code, what they have by themselves.
    single: Table

    @classmethod
    def of(cls, model: Model, blobs: dict[int, list[bytes]]) -> Values:
        names = model.shared.names
        d1, d2, d3 = model.discounts
        nothing = Table.of(np.zeros(0, np.uint64), np.zeros(0))
        if TRIGRAMS not in blobs:
            return cls(*[nothing] * 5)
        own = Shard.of(blobs[TRIGRAMS][0], names)
        several = Table.of(*unpack(blobs[SINGLE][0], ["u8", "i8"])) if SINGLE in blobs else nothing

        def n1_of(code: np.ndarray, word: np.ndarray) -> np.ndarray:
            found = model.n1[np.minimum(code, len(names) - 1)]
            rest = code == len(names)
            found[rest] = several.get(word[rest], 1.0)
            return found

        context, of_context = np.unique(chain(own.words[0], own.words[1]), return_inverse=True)
        left3 = np.bincount(of_context, cut(own.n3, d3)) / (of3 := np.bincount(of_context, own.n3))
        bigram, first, of_bigram, n2 = own.bigrams
        word2, code3, word3 = own.words[1][first], own.codes[2][first], own.words[2][first]
        if SPLIT in blobs:
            # All bigrams of a split word, with their counts over all its shards.
            w2, w3, n = unpack(blobs[SPLIT][0], ["u8", "u8", "i8"])
            other = chain(w2, w3)
            order = np.argsort(other)
            at = order[np.minimum(np.searchsorted(other, bigram, sorter=order), len(other) - 1)]
            n2 = np.where(other[at] == bigram, n[at], n2)
            away = ~np.isin(other, bigram)
            by_name = np.argsort(names)
            code = by_name[np.minimum(np.searchsorted(names, w3, sorter=by_name), len(names) - 1)]
            code = np.where(names[code] == w3, code, len(names))
            bigram, n2, word2, word3, code3 = (
                np.append(x, y[away]) for x, y in ((bigram, other), (n2, n), (word2, w2), (word3, w3), (code3, code))
            )
        middle, of_middle = np.unique(word2, return_inverse=True)
        of2, cut2 = np.bincount(of_middle, n2), np.bincount(of_middle, cut(n2, d2))
        left2 = cut2 / of2
        p1 = model.p1(n1_of(code3, word3).astype(np.int64))
        p2 = (n2 - cut(n2, d2)) / of2[of_middle] + left2[of_middle] * p1
        p3 = (own.n3 - cut(own.n3, d3)) / of3[of_context] + left3[of_context] * p2[of_bigram]
        trigram = chain(context[of_context], own.words[2])
        alone = np.unique(own.words[1][own.codes[1] == len(names)])
        return cls(
            Table.of(trigram, np.log(p3 / p1[of_bigram])),
            Table.of(context, np.log(left3)),
            Table.of(bigram, np.log(p2 / p1)),
            Table.of(middle, np.log(left2)),
            Table.of(alone, np.log(model.p1(several.get(alone, 1.0).astype(np.int64)))),
        )

    def add(self, codes: list[np.ndarray], words: list[np.ndarray], hot: int, unknown: float) -> tuple[np.ndarray, np.ndarray]:
        """Of each trigram: what it adds to its text's log-probability, and whether the model holds it."""
        context = chain(words[0], words[1])
        at = self.trigrams.places(chain(context, words[2]))
        value = self.trigrams.values[at].astype(np.float64)
        known = at < len(self.trigrams.keys) - 1
        rest = np.flatnonzero(~known)
        value[rest] = self.contexts.get(context[rest])
        w2, w3 = words[1][rest], words[2][rest]
        at = self.bigrams.places(chain(w2, w3))
        shorter = at < len(self.bigrams.keys) - 1
        value[rest] += self.bigrams.values[at]
        value[rest[~shorter]] += self.middles.get(w2[~shorter])
        alone = np.flatnonzero(codes[1] == hot)
        value[alone] += self.single.get(words[1][alone], math.log(unknown))
        return value, known


def log_probabilities(docs: DataFrame, model: Model, carry: list[str]) -> DataFrame:
    """``carry``, n_words, log_probability and known (longest n-grams that the model holds) of the column ``text``.

    A task sums what single words add, and sends each trigram of its texts to the shard of its middle word, unless the model does not
    know that word; sums come back by text. That is done for ``PASSES`` parts of the shards in turn, so that only a part of
    the trigrams is on the way at once. The end of a text counts as
    a word in all but n_words; a text without words has 0 and 0. Texts are numbered by partition and place, so a
    repeated task, and each pass, must see the rows in the same order, as it does when they come from files.
    """
    sent = docs.sparkSession.sparkContext.broadcast(replace(model, rows=None, tables=()))
    own = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own)], "text")
    types = [rows.schema[o].dataType.simpleString() for o in own]
    about = f"struct<{', '.join(f'{o}:{t}' for o, t in zip(own, types))}{', ' if own else ''}n_words:bigint, sum:double>"
    sums = []
    with shuffles_freed(docs.sparkSession, ROWS_AT_ONCE):
        for number in range(PASSES):
            dealt = rows.mapInArrow(_dealer(sent, number, PASSES, len(own)), f"shard int, kind byte, row long, blob binary, about {about}")
            part = model.rows.filter(F.col("shard") % PASSES == number)
            part = part.select("shard", "kind", F.lit(0).cast("long").alias("row"), "blob", F.lit(None).cast(about).alias("about"))
            together = part.unionByName(dealt).repartition("shard").sortWithinPartitions("shard", "kind")
            added = together.mapInArrow(_adder(sent), f"block long, row long, blob binary, about {about}")
            added = added.repartition("block").sortWithinPartitions("block")
            sums.append(materialize(added.mapInArrow(_totals, f"row long, about {about}, more double, known long"), "text-sums"))
    sent.destroy()
    found = reduce(DataFrame.unionByName, sums).groupBy("row").agg(
        F.first("about", ignorenulls=True).alias("about"), F.sum("more").alias("more"), F.sum("known").alias("known")
    )
    return found.select(
        *[F.col(f"about.{o}").alias(c) for o, c in zip(own, carry)],
        F.col("about.n_words").alias("n_words"),
        (F.col("about.sum") + F.coalesce("more", F.lit(0.0))).alias("log_probability"),
        F.coalesce("known", F.lit(0)).cast("long").alias("known"),
    )


def _dealer(sent: Broadcast, turn: int, turns: int, carried: int) -> Callable:
    """Texts to rows of shards; in the first turn with a row about each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model = sent.value
        shared = model.shared
        hot = len(shared.names)
        alone = np.append(np.log(model.p1(model.n1)), 0.0)
        alone[[UNKNOWN_CODE, START_CODE]] = math.log(model.unknown), 0.0
        number = TaskContext.get().partitionId() << 36

        def emit(batch: pa.RecordBatch, first: int, words: pa.Array, n_words: np.ndarray) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(n_words))
            full = np.flatnonzero(n_words)
            found: list[tuple] = []
            if len(full):
                numbers, names = shared.numbers(words, model.known)
                of, *words = numbered(numbers, n_words[full])
                of = full[of]
                total = np.bincount(of, alone[np.minimum(words[2], hot)], len(n_words))
                shard = shared.shards_of(words[0], words[1], names)
                here = np.flatnonzero((shard % turns == turn) & (words[1] != UNKNOWN_CODE))
                of, shard, *words = (x[here] for x in (of, shard, *words))
                for i in range(0, len(of), PLACES):
                    part = [w[i : i + PLACES] for w in words]
                    for s, at in runs(shard[i : i + PLACES]):
                        row = of[i : i + PLACES][at]
                        step = np.diff(row, prepend=row[0]).astype(np.uint32)
                        found.append((s, number + first + int(row[0]), pack_words([w[at] for w in part], names, hot, step)))
            about = struct(batch, first, n_words, total)
            yield record([s for s, _, _ in found], TEXTS, [r for _, r, _ in found], [b for _, _, b in found], pa.nulls(len(found), about.type))
            if turn == 0:
                ids = number + first + np.arange(len(n_words))
                yield record(-1 - (mix64(ids.astype(np.uint64)) % np.uint64(1 << 20)).astype(np.int64), ABOUT, ids, [None] * len(ids), about)

        def struct(batch: pa.RecordBatch, first: int, n_words: np.ndarray, total: np.ndarray) -> pa.StructArray:
            kept = [batch.column(i).slice(first, len(n_words)) for i in range(carried)]
            kind = [*[batch.schema.field(i) for i in range(carried)], pa.field("n_words", pa.int64()), pa.field("sum", pa.float64())]
            return pa.StructArray.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(total, pa.float64())], fields=kind)

        for batch in batches:
            for first, words, n_words in slices(batch.column(carried)):
                yield from emit(batch, first, words, n_words)
            number += batch.num_rows
            pa.default_memory_pool().release_unused()

    def record(shard, kind: int, row, blob: list, about: pa.Array) -> pa.RecordBatch:
        columns = [pa.array(shard, pa.int32()), pa.array([kind] * len(blob), pa.int8()), pa.array(row, pa.int64()), pa.array(blob, pa.binary()), about]
        return pa.RecordBatch.from_arrays(columns, names=["shard", "kind", "row", "blob", "about"])

    return run


def _adder(sent: Broadcast) -> Callable:
    """Rows of shards to sums by text, packed for blocks of texts; rows about texts go through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        hot = len(model.shared.names)
        current = values = None
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            shard, kind, row, blob, about = batch.columns
            kinds = kind.to_numpy()
            told = pa.array(np.flatnonzero(kinds == ABOUT))
            yield out(row.take(told).to_numpy() >> BLOCK_BITS, row.take(told), pa.nulls(len(told), pa.binary()), about.take(told))
            for i in np.flatnonzero(kinds != ABOUT).tolist():
                if (s := shard[i].as_py()) != current:
                    current, values, blobs = s, None, {}  # one shard's values at a time
                if kinds[i] != TEXTS:
                    blobs.setdefault(int(kinds[i]), []).append(blob[i].as_py())
                    continue
                if values is None:
                    values, blobs = Values.of(model, blobs), {}
                    pa.default_memory_pool().release_unused()
                codes, words, (step,) = unpack_words(blob[i].as_py(), model.shared.names, "u4")
                place = np.cumsum(step, dtype=np.int64)
                value, known = values.add(codes, words, hot, model.unknown)
                there = np.flatnonzero(np.bincount(place))
                more, n = np.bincount(place, value)[there].astype(np.float32), np.bincount(place, known)[there].astype(np.uint32)
                there += row[i].as_py()
                first = int(there[0]) >> BLOCK_BITS
                found = [
                    (first + b, pack((there[at] & (1 << BLOCK_BITS) - 1).astype(np.uint16), more[at], n[at]))
                    for b, at in runs((there >> BLOCK_BITS) - first)
                ]
                none = len(found)
                yield out([b for b, _ in found], pa.nulls(none, pa.int64()), pa.array([x for _, x in found], pa.binary()), pa.nulls(none, about.type))

    def out(block, row: pa.Array, blob: pa.Array, about: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), row, blob, about], names=["block", "row", "blob", "about"])

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of all shards, a row per text; they come in order of blocks. Rows about texts go through."""
    current = kind = None
    more, known = np.zeros(1 << BLOCK_BITS), np.zeros(1 << BLOCK_BITS, np.int64)
    there = np.zeros(1 << BLOCK_BITS, bool)

    def out(row: pa.Array, about: pa.Array, more: np.ndarray, known: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([row, about, pa.array(more), pa.array(known)], names=["row", "about", "more", "known"])

    def ended() -> pa.RecordBatch:
        at = np.flatnonzero(there)
        batch = out(pa.array((current << BLOCK_BITS) + at), pa.nulls(len(at), kind), more[at], known[at])
        more[:], known[:], there[:] = 0, 0, False
        return batch

    for batch in batches:
        block, row, blob, about = batch.columns
        kind = about.type
        told = pc.is_null(blob)
        none = np.zeros(pc.sum(told).as_py() or 0)
        yield out(row.filter(told), about.filter(told), none, none.astype(np.int64))
        for b, data in zip(block.to_pylist(), blob.to_pylist()):
            if data is None:
                continue
            if b != current:
                if current is not None:
                    yield ended()
                current = b
            at, x, n = unpack(data, ["u2", "f4", "u4"])
            more[at] += x
            known[at] += n
            there[at] = True
    if current is not None:
        yield ended()
