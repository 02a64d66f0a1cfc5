"""N-gram Jaccard join with token-combination prefixes, and the components of its links.

A document's tokens are the 64-bit hashes of its distinct shingles, of ``shingle`` words. Two documents link
when 100 * |A n B| >= ``percent`` * |A u B|; the query has 3 words and 90, for which the steps are told. Links are found in steps that lose none:

1. Documents of equal token sets form a class; only classes go on, so copies cost one row each.
2. Sieve: a set of n tokens has at most s(n) = n - ceil(0.9 n) that a linked set lacks, so with tokens in
   hash order the k-th common one is among the first k + s of either. Each set shows its first
   s(n) + s(n / 0.9) + 1; as a partner has at least 0.9 n tokens, it shows enough for s(n) + 1 common ones,
   whichever of the two is larger. Classes of which fewer are shown by others are alone.
3. With p = s(n) + 1, for the rest, tokens are put in order of how many classes have them, rarest first. Linked sets
   share at least k tokens among their first p - 1 + k. A token that at most ``RARE`` classes have is
   a key by itself. Frequent tokens are keys only in combinations: they fall into g = k - 1 groups by
   hash, so of k shared ones two are in one group, and the pairs inside the groups are the keys. g is a
   power of two near p / 4, chosen by size; sizes near a border use both values.
   Near copies share many keys, most with the same members; one of the keys with the same members stays.
4. Classes that meet in a key are verified in rounds. In each round a key's pivots, few at first, are
   compared with its other members, unless both are in one component already or sizes, the numbers of
   tokens that nobody else has, or the parity sketches rule a link out. Two classes are compared at the least key
   they share: each posting knows the least ``LEAST_KEYS`` keys of its class, and a pair that has a lesser one in
   common is left to that one, so a pair is made about once, however many keys it shares. A sketch has a bit for each of
   ``SKETCH_BITS`` shares of the tokens, set if the class has an odd number of them, so two sets differ
   in at least as many tokens as their sketches in bits. Compared pivots leave the key; keys inside one
   component close. Groups whose members all link need about one comparison a member, not all pairs.

A document with fewer words than a shingle has one token, its whole word sequence; without words it has
none and links with nothing. Null text counts as empty. Repeated rows are one class. Null ids stay
null; an id that is null is never the least. Empty input gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitspark.llm.bloom import bloom_filter, in_filter
from waitspark.llm.common import WordHashes, binary_texts, free_names, mix64, text_or_empty
from waitspark.llm.components import components
from waitspark.llm.kneser_ney import chain, names, text_hashes
from waitspark.llm.mixing import row_key
from waitspark.workspace import discard, materialize

#: The query's: links need 100 * intersection >= PERCENT * union of the sets of SHINGLE words.
SHINGLE = 3
PERCENT = 90
RARE = 64
SKETCH_BITS = 256
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
FIRST_PIVOTS, PIVOT_GROWTH = 2, 4
LEAST_KEYS = 8
#: What a class brings to its postings.
SIDE = [*SKETCH, "least_keys"]


def token_set(text: bytes, cache: WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct tokens of a text."""
    h = text_hashes(text, cache)
    if len(h) >= shingle:
        return np.unique(names(h, shingle)[-1][shingle - 1 :])
    if not len(h):
        return h
    whole = np.uint64(len(h))
    for k in range(len(h)):
        whole = chain(whole.reshape(1), h[k : k + 1])[0]
    return np.array([whole], dtype=np.uint64)


def parity_sketch(tokens: np.ndarray) -> list[int]:
    share = (tokens >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)).astype(np.int64)
    odd = np.bincount(share, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def least_overlap(n: int, percent: int = PERCENT) -> int:
    return -(-n * percent // 100)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - least_overlap(n, percent) + 1


def sieve_size(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set shows in the sieve: enough for all partners, whose own spare tokens may be more or fewer."""
    return min(n, prefix_size(n, percent) + prefix_size(n * 100 // percent, percent) - 1)


def sets(docs: DataFrame, whole: bool, key: str = "doc_id", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, ``key``, n, sig, tokens (the whole set, or its first by hash that the sieve needs), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            n, sig, tokens, sketch = [], [], [], []
            for text in binary_texts(batch.column(2)):
                found = token_set(text, cache, shingle)
                n.append(len(found))
                sig.append(hashlib.md5(found.tobytes()).digest())
                tokens.append(found if whole else found[: sieve_size(len(found), percent)])
                sketch.append(parity_sketch(found))
            offsets = np.append(0, np.cumsum([len(t) for t in tokens])).astype(np.int32)
            values = np.concatenate(tokens).view(np.int64) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sig, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)), pa.array(sketch, pa.list_(pa.int64()))],
                names=["doc_id", "key", "n", "sig", "tokens", "sketch"],
            )

    rows = docs.select("doc_id", F.col(key).alias("key"), text_or_empty().alias("text"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(
        run, f"doc_id {kinds['doc_id']}, key {kinds['key']}, n long, sig binary, tokens array<long>, sketch array<long>"
    )


def signature(n: int, tokens: np.ndarray, counts: np.ndarray, rare: int = RARE, percent: int = PERCENT) -> list[int]:
    """Keys of a class of ``n`` tokens; ``tokens`` are those that other classes have, with how many have each."""
    alone = n - len(tokens)
    p = prefix_size(n, percent)
    if alone >= p:
        return []
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    levels = range(_level(least_overlap(n, percent), percent), _level(n * 100 // percent, percent) + 1)
    keys: list[np.ndarray] = []
    widest = p + (1 << levels[-1]) - alone
    first = tokens[:widest]
    keys.append(mix64(first[counts[:widest] <= rare]))
    for level in levels:
        groups = 1 << level
        within = slice(0, p + groups - alone)
        frequent = tokens[within][counts[within] > rare]
        if len(frequent) < 2:
            continue
        group = (mix64(frequent ^ np.uint64(0xC0FFEE)) & np.uint64(groups - 1)).astype(np.int64)
        for g in np.flatnonzero(np.bincount(group) > 1):
            members = np.sort(frequent[group == g])
            i, j = np.triu_indices(len(members), 1)
            keys.append(mix64(chain(members[i], members[j]) + np.uint64(level + 1)))
    return np.unique(np.concatenate(keys)).view(np.int64).tolist()


def _level(n: int, percent: int) -> int:
    return max(0, (prefix_size(max(n, 1), percent) // 4).bit_length() - 1)


def keys(classes: DataFrame, rare: int = RARE, percent: int = PERCENT) -> DataFrame:
    """(key, cid, n, alone) from (cid, n, shared: array of (count, token))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column(2)
            offsets = shared.offsets.to_numpy()
            values = shared.values
            counts = values.field(0).to_numpy(zero_copy_only=False)
            tokens = values.field(1).to_numpy(zero_copy_only=False).view(np.uint64)
            for i, (cid, n) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                part = slice(offsets[i], offsets[i + 1])
                found = signature(n, tokens[part], counts[part], rare, percent)
                if found:
                    m = len(found)
                    alone = n - int(offsets[i + 1] - offsets[i])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found, pa.int64()), pa.array([cid] * m, pa.int64()), pa.array([n] * m, pa.int64()), pa.array([alone] * m, pa.int64())],
                        names=["key", "cid", "n", "alone"],
                    )

    return classes.select("cid", "n", "shared").mapInArrow(run, "key long, cid long, n long, alone long")


def meeting_keys(postings: DataFrame) -> DataFrame:
    """key: of the keys that the same two or more classes of ``postings`` (key, cid) have, the least.

    Sets of members are told apart by their size and 128 bits of their members' hashes.
    """
    marks = [F.bit_xor(F.xxhash64("cid", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    members = postings.groupBy("key").agg(F.count("*").alias("m"), *marks).filter("m > 1")
    return members.groupBy("m", "mark0", "mark1").agg(F.min("key").alias("key")).select("key")


def least_keys(postings: DataFrame) -> DataFrame:
    """(cid, least_keys) of ``postings`` (key, cid): the first ``LEAST_KEYS`` keys of each class."""
    place = F.row_number().over(Window.partitionBy("cid").orderBy("key"))
    first = postings.select("cid", "key", place.alias("place")).filter(F.col("place") <= LEAST_KEYS)
    return first.groupBy("cid").agg(F.collect_list("key").alias("least_keys"))


def shared_tokens(rows: DataFrame) -> DataFrame:
    """(token, count) of tokens that at least two classes of ``rows`` (cid, tokens) have."""
    tokens = rows.select(F.explode("tokens").alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("count")).filter(F.col("count") > 1)


def sieved(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """cid of the classes that the sieve leaves."""
    counts = shared_tokens(classes)
    rows = classes.select("cid", "n", F.explode("tokens").alias("token"))
    hits = rows.join(counts.select("token"), "token", "left_semi").groupBy("cid", "n").agg(F.count("*").alias("hits"))
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    return hits.filter(F.col("hits") > spare).select("cid")


def linkable(a: str, b: str, percent: int = PERCENT) -> Column:
    """Whether sizes, tokens that no other class has, and sketches leave room for a link."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    fits = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    differ = F.lit(0)
    for s in SKETCH:
        differ = differ + F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}")))
    differ = F.greatest(differ, F.col(f"{a}.alone") + F.col(f"{b}.alone"))
    return fits & ((100 + percent) * differ <= (100 - percent) * (na + nb))


def linked(pairs: DataFrame, members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) of those ``pairs`` whose sets link; ``members`` has (cid, tokens)."""
    left = members.select(F.col("cid").alias("a"), F.col("tokens").alias("left"))
    right = members.select(F.col("cid").alias("b"), F.col("tokens").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def class_components(members: DataFrame, postings: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(cid, comp and more) of all ``members`` (cid, tokens, sketch); ``postings`` are the keys they meet in."""
    first = members.select("cid", F.col("cid").alias("comp"), *SKETCH).join(least_keys(postings), "cid", "left")
    comps, last = materialize(first, "comps"), None
    open_, pivots = postings, FIRST_PIVOTS
    while True:
        comps, live = _round(comps, open_, members, pivots, percent)
        if last is not None:
            discard(last)
        if live is None:
            return comps
        open_, last = live.filter("NOT pivot").select("key", "cid", "n", "alone"), live
        pivots *= PIVOT_GROWTH


def _round(comps: DataFrame, postings: DataFrame, members: DataFrame, pivots: int, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """(components after verifying the pivots of each key against its members, those keys' postings or None)."""
    open_ = postings.join(comps, "cid")
    least = F.min(F.struct("alone", "cid"))
    stats = open_.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("members"), least.alias("first")
    )
    stats = materialize(stats.filter("low <> high"), "stats")
    chosen = (F.pmod(F.xxhash64("cid"), F.lit(1 << 20)) * F.col("members") < pivots * (1 << 20)) | (F.col("cid") == F.col("first.cid"))
    live = open_.join(stats.select("key", "members", "first"), "key")
    lesser = F.filter("least_keys", lambda k: k < F.col("key")).alias("lesser")
    live = materialize(live.select("key", "cid", "n", "alone", "comp", *SKETCH, lesser, chosen.alias("pivot")), "live")
    discard(stats)
    if live.limit(1).count() == 0:
        discard(live)
        return comps, None
    pairs = materialize(candidates(live, percent).distinct(), "pairs")
    found = materialize(linked(pairs, members, percent), "found")
    discard(pairs)
    if found.limit(1).count():
        merged = _merged(comps, found)
        discard(comps)
        comps = merged
    discard(found)
    return comps, live


def candidates(live: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) of a key's pivots and its other members that may link and share no lesser key that both know."""
    a, b = live.alias("a"), live.filter("pivot").alias("b")
    differ = (F.col("a.comp") != F.col("b.comp")) & (~F.col("a.pivot") | (F.col("a.cid") < F.col("b.cid")))
    elsewhere = F.arrays_overlap("a.lesser", "b.lesser")
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & differ & linkable("a", "b", percent) & ~elsewhere)
    return pairs.select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b"))


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` after joining the components that ``links`` (a, b) of classes connect."""
    left = comps.select(F.col("cid").alias("a"), F.col("comp").alias("x"))
    right = comps.select(F.col("cid").alias("b"), F.col("comp").alias("y"))
    between = links.join(left, "a").join(right, "b").filter("x <> y")
    roots = components(between.select(F.col("x").alias("a"), F.col("y").alias("b")))
    moved = comps.join(roots, comps["comp"] == roots["node"], "left")
    return materialize(moved.select("cid", F.coalesce("root", "comp").alias("comp"), *SIDE), "comps")


def join_components(
    docs: DataFrame, key: str = "doc_id", rare: int = RARE, shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, ``key``, n_shingles, component_id and comp (null without words) for each row of ``docs``."""
    found = materialize(sets(docs, False, key, shingle, percent).drop("sketch"), "token-sets")
    rows = materialize(found.drop("tokens"), "signatures")
    grouped = found.filter("n > 0").groupBy("sig", "n").agg(F.min("doc_id").alias("least"), F.first("tokens").alias("tokens"))
    shown = materialize(grouped.withColumn("cid", F.monotonically_increasing_id()), "shown")
    discard(found)
    classes = materialize(shown.drop("tokens"), "classes")
    left = materialize(sieved(shown, percent), "sieved")
    discard(shown)
    wanted = classes.select("cid", "sig", "n", "least").join(left, "cid", "left_semi")
    wanted = materialize(wanted, "wanted")
    texts = docs.select("doc_id", "text")
    texts = texts.join(wanted.select(F.col("least").alias("_least")).distinct(), F.col("doc_id").eqNullSafe(F.col("_least")), "left_semi")
    members = sets(texts, True, shingle=shingle, percent=percent).select(F.col("sig").alias("_sig"), "tokens", "sketch")
    members = members.join(wanted, F.col("_sig") == F.col("sig"))
    members = members.groupBy("cid", "n").agg(F.first("tokens").alias("tokens"), F.first("sketch").alias("sketch"))
    members = members.select("cid", "n", "tokens", *[F.get("sketch", F.lit(i)).alias(s) for i, s in enumerate(SKETCH)])
    members = materialize(members, "members")
    shared = members.select("cid", "n", F.explode("tokens").alias("token")).join(shared_tokens(members), "token")
    shared = shared.groupBy("cid", "n").agg(F.collect_list(F.struct("count", "token")).alias("shared"))
    postings = keys(shared, rare, percent)
    postings = materialize(postings, "postings")
    met = materialize(postings.join(meeting_keys(postings), "key", "left_semi"), "met")
    discard(postings)
    comps = class_components(members.drop("n"), met, percent)
    discard(members, met)
    with_least = classes.select("cid", "sig", "least").join(comps, "cid", "left")
    with_least = materialize(with_least.withColumn("comp", F.coalesce("comp", "cid")), "with-least")
    smallest = with_least.groupBy("comp").agg(F.min("least").alias("component_id"))
    of_sig = materialize(with_least.join(smallest, "comp").select(F.col("sig").alias("_sig"), "component_id", "comp"), "of-sig")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        rows.select("doc_id", "key", "n", "sig")
        .join(of_sig, F.col("sig") == F.col("_sig"), "left")
        .select("doc_id", F.col("key").alias("_key"), F.col("n").alias("n_shingles"), component.alias("component_id"), "comp")
    )


def op7(docs: DataFrame, rare: int = RARE) -> DataFrame:
    return join_components(docs, rare=rare).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, that of the least doc_id, with all its columns.

    Rows without words are components of their own and all stay. Rows are told apart by a digest of all
    columns, so rows that share an id do not stand for each other; twins equal in all columns count once.
    A filter holds the digests of rows that go and of twins: other rows pass without a shuffle.
    """
    row, mark = free_names([*docs.columns, "doc_id"], "_row", "_stay")
    keyed = docs.withColumn(row, row_key(docs))
    found = materialize(join_components(keyed, row, shingle=shingle, percent=percent), "join-rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_key")))
    stay = found.filter("comp IS NOT NULL").groupBy("comp").agg(least.alias("least"))
    stay = materialize(stay.select(F.col("least._key").alias(mark)), "stay")
    counts = found.filter("comp IS NOT NULL").groupBy("_key").agg(F.count("*").alias("n"))
    single = stay.withColumn("single", F.lit(True))
    open_ = counts.join(single, F.col("_key") == F.col(mark), "left").filter("n > 1 OR single IS NULL")
    bloom = bloom_filter(open_, "_key")
    settled, keyed = in_filter(keyed, bloom, row, inside=False), in_filter(keyed, bloom, row)
    wordless = found.filter("comp IS NULL").select(F.col("_key").alias(mark)).distinct()
    one = keyed.join(stay, F.col(row) == F.col(mark), "left_semi").dropDuplicates([row])
    rest = keyed.join(wordless, F.col(row) == F.col(mark), "left_semi")
    return settled.unionByName(one).unionByName(rest).select(*docs.columns)
