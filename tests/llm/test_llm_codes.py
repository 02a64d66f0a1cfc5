"""Merkle manifest, embedding whitening and byte-level BPE against plain Python."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import ROWS, docs, plain
from waitspark.llm import byte_bpe, embedding_whitening, merkle_manifest
from waitspark.llm.merkle_manifest import Parent
from waitspark.llm.spectrum import Spectrum, secular_roots

LINES = open(byte_bpe.default_ranks(), "rb").read()
RANKS = byte_bpe.load_ranks(LINES)

# Byte-level BPE


def merged(piece: bytes) -> list[int]:
    """The ids of one match: always merge the leftmost pair of least rank."""
    if piece in RANKS:
        return [RANKS[piece]]
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((RANKS.get(a + b, 1 << 30), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 30:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [RANKS[p] for p in parts]


def brute_ids(text: str) -> list[int]:
    return [i for piece in regex.findall(public_tokenizers.PATTERN, text) for i in merged(piece.encode())]


def packed(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def test_op13_equals_brute_force(spark):
    rows = [(i, t, None, None, None, None, None) for i, t in enumerate(["It's 12  o'clock\n\n é漢字 \x85x", " \n ", "a\tb", "x  "])]
    short = [r for r in ROWS if len(r[1] or "") < 1000] + rows
    got = byte_bpe.op13(docs(spark, short)).collect()
    expected = []
    for doc_id, text, *_ in short:
        ids = brute_ids(text or "")
        expected.append(
            (doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        )
    assert plain(got) == sorted(expected, key=repr)


PIECES = st.sampled_from(["word", " ", "  ", "\n", "'s", "'", "!", "7", "é", "漢", " ", "\t", "X", "   \n ", "…", "ا"])


@settings(max_examples=150, deadline=None)
@given(st.lists(PIECES, max_size=60))
def test_parts_do_not_change_the_ids(pieces):
    text = "".join(pieces)
    bpe = byte_bpe.codec(LINES, public_tokenizers.PATTERN)
    whole = bpe.encoding.encode_ordinary(text)
    saved = byte_bpe.LONG, byte_bpe.LONG_RUN
    byte_bpe.LONG, byte_bpe.LONG_RUN = 3, byte_bpe.re.compile(f"[{byte_bpe.WHITE}]{{3,}}")
    try:
        assert "".join(part for part, _ in byte_bpe.parts(text)) == text
        assert bpe._long(text) == whole
    finally:
        byte_bpe.LONG, byte_bpe.LONG_RUN = saved


def test_white_space_is_what_the_pattern_means():
    bpe = byte_bpe.codec(LINES, public_tokenizers.PATTERN)
    for code in [*range(0x300), *range(0x1680, 0x1681), *range(0x1FFF, 0x2070), *range(0x2FFF, 0x3002), 0xFEFF]:
        char = chr(code)
        # Two of a kind before a letter part only if they are white space and no letter, digit or sign.
        alone = bpe.encoding.encode_ordinary(char * 2 + "a") == bpe.encoding._encode_single_piece((char).encode()) + (
            bpe.encoding.encode_ordinary(char + "a")
        )
        if char in byte_bpe.WHITE:
            assert alone, hex(code)
        assert (regex.fullmatch(r"\s", char) is not None) == (char in byte_bpe.WHITE), hex(code)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 1_500_000 + "x", "a b" * 400_000, "x" * 300_000 + " " * 5000 + "y"])
def test_very_long_texts_round_trip(spark, text):
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    coded = byte_bpe.decode(byte_bpe.encode(one)).first()
    assert bytes(coded["decoded"]) == text.encode()
    assert coded["n_tokens"] == len(coded["ids"])


def test_long_white_space_is_one_match():
    bpe = byte_bpe.codec(LINES, public_tokenizers.PATTERN)
    for tail in ("", "x", "\n", "\nx"):
        text = "a " + " " * 20_000 + tail
        assert bpe.encode(text).tolist() == bpe.encoding.encode_ordinary(text)


def test_decode_raw_bytes_nulls_and_empty_tables(spark):
    half = RANKS["é".encode()[:1]]
    rows = spark.createDataFrame([([half],), (None,), ([],)], "ids array<int>")
    assert {bytes(r["decoded"]) if r["decoded"] is not None else None for r in byte_bpe.decode(rows).collect()} == {
        "é".encode()[:1],
        None,
        b"",
    }
    assert byte_bpe.op13(docs(spark, [])).collect() == []


def test_encode_keeps_columns_of_its_own_names(spark):
    rows = docs(spark, ROWS[:3]).withColumns({"_text": F.lit("mine"), "ids": F.lit("theirs"), "decoded": F.lit(1)})
    got = byte_bpe.encode(rows)
    assert got.columns == [c for c in rows.columns if c != "ids"] + ["ids", "n_tokens"]
    assert {r["_text"] for r in got.collect()} == {"mine"}


# Merkle manifest


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(doc_id, text, lang, source, n_chars, lower=False):
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    values = [doc_id, source, lang, n_chars, text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(digests):
    """(top, for each node its siblings level by level)."""
    paths = [[] for _ in digests]
    place = list(range(len(digests)))
    while len(digests) > 1:
        for own, at in zip(paths, place):
            run = digests[at // 16 * 16 : at // 16 * 16 + 16]
            own.append((run[: at % 16], run[at % 16 + 1 :]))
        place = [p // 16 for p in place]
        digests = [h("".join(digests[i : i + 16])) for i in range(0, len(digests), 16)]
    return digests[0], paths


def brute_manifest(rows):
    groups = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = brute_leaf(doc_id, text, lang, source, n_chars)
        held = brute_leaf(doc_id, text, lang, source, n_chars, True)
        key = (source is not None, (source or "").encode())
        groups.setdefault(key, []).append(((doc_id is not None, doc_id or 0, leaf), doc_id, held))
    tops = []
    for key in sorted(groups):
        groups[key].sort(key=lambda x: x[0])
        tops.append(climb([x[0][2] for x in groups[key]]))
    root, upper = climb([top for top, _ in tops])
    out = []
    for key, (top, paths), above in zip(sorted(groups), tops, upper):
        for (order, doc_id, held), own in zip(groups[key], paths):
            tampered = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0
            value = held if tampered else order[2]
            for left, right in own + above:
                value = h("".join([*left, value, *right]))
            proof = h("".join("".join(left + right) for left, right in own + above))
            out.append((doc_id, order[2], top, root, proof, value, value == root))
    return out


def test_parent_folds_like_hashing_again():
    children = [h(str(i)) for i in range(16)]
    parent = Parent(children)
    assert parent.digest == h("".join(children))
    for i in range(16):
        changed = [*children[:i], h("other"), *children[i + 1 :]]
        assert parent.fold(i, h("other")) == h("".join(changed))
        assert parent.siblings(i) == ("".join(children[:i]), "".join(children[i + 1 :]))


def test_op11_equals_brute_force_on_awkward_rows(spark):
    got = merkle_manifest.op11(docs(spark)).collect()
    assert plain(got) == sorted(brute_manifest(ROWS), key=repr)


@pytest.mark.parametrize("sizes", [(1,), (16, 1), (17, 256, 2), (257, 300, 1, 5), (4097,)])
def test_op11_equals_brute_force_on_many_levels(spark, sizes):
    rows, doc_id = [], 0
    for k, size in enumerate(sizes):
        for _ in range(size):
            doc_id += 1
            rows.append((doc_id * 7 % 10_007, f"Text {doc_id}", None, "s" * k or None, doc_id, "x", 1.0))
    got = merkle_manifest.op11(docs(spark, rows)).collect()
    assert plain(got) == sorted(brute_manifest(rows), key=repr)


def test_op11_of_many_groups(spark):
    rows = [(i, "A", "en", f"é{i}", 1, "x", 1.0) for i in range(300)]
    got = merkle_manifest.op11(docs(spark, rows)).collect()
    assert plain(got) == sorted(brute_manifest(rows), key=repr)


def test_manifest_groups_and_empty_table(spark):
    manifest = merkle_manifest.build(merkle_manifest.leaves_of(docs(spark)))
    groups = {r["group"]: r["n"] for r in manifest.groups().collect()}
    assert groups == {None: 2, "a": 3, "b": 2, "c": 5, "d": 2}
    assert all(r["folded_root"] == manifest.root for r in merkle_manifest.prove(manifest).collect())
    assert merkle_manifest.op11(docs(spark, [])).collect() == []


# Embedding whitening


def brute_whitening(vectors):
    x = np.array([[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    centred = apart.astype(float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return (apart**2).sum(axis=1), centred @ axes / np.sqrt(values), values / values.sum()


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_op12_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(700, 40)) * np.linspace(0.2, 1, 40)).astype(np.float32)
    vectors[300:500] = vectors[0]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    bad = [(1000, None, 0), (1001, [], 0), (1002, [1.0] * 39 + [float("nan")], 0), (1003, [float("inf")] * 40, 0)]
    bad += [(1004, [1.0] * 39 + [None], 0), (1005, [1.0] * 3, 0)]
    got = embedding_whitening.op12(embeddings(spark, rows + bad).repartition(5)).toPandas()
    deviation, white, explained = brute_whitening(vectors)
    assert sorted(set(got["vec_id"])) == list(range(700))
    assert set(got["n"]) == {700} and len(got) == 700 * 32
    table = got.sort_values(["vec_id", "component"])
    own = table["whitened"].to_numpy().reshape(700, 32)
    signs = np.sign((own * white[:, :32]).sum(axis=0))
    assert np.abs(own * signs - white[:, :32]).max() < 1e-9
    assert table["deviation"].to_numpy()[::32].tolist() == deviation.tolist()
    assert np.abs(table["explained"].to_numpy()[:32] - explained[:32]).max() < 1e-12
    assert set(got["identity_error"]) == {got["identity_error"][0]} and got["identity_error"][0] < 1e-9


def test_op12_without_spread_and_without_rows(spark):
    same = embedding_whitening.op12(embeddings(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect()
    assert [(r["vec_id"], r["component"], r["whitened"], r["explained"]) for r in same] == [
        (i, k, None, 0.0) for i in (1, 2) for k in (1, 2)
    ]
    line = embedding_whitening.op12(embeddings(spark, [(i, [float(i), 1.0, 2.0 * i], 0) for i in range(4)])).collect()
    assert {r["component"] for r in line if r["whitened"] is not None} == {1}
    assert embedding_whitening.op12(embeddings(spark, [])).collect() == []
    assert embedding_whitening.op12(embeddings(spark, [(1, None, 0)])).collect() == []


def test_whiten_keeps_columns_and_wide_numbers(spark):
    rows = [(i, [float((-1) ** i * 2**50 * (i % 3)), float(i)], i) for i in range(9)]
    df = embeddings(spark, rows).withColumns({"_whole": F.lit("mine"), "whitened": F.lit("old")})
    model = embedding_whitening.fit(df)
    got = embedding_whitening.whiten(df, model).collect()
    assert {r["_whole"] for r in got} == {"mine"} and len(got) == 9
    assert all(r["deviation"] is None for r in got if r["vec_id"] % 3)


def scatter(rows):
    apart = rows - rows.mean(axis=0)
    return apart.T @ apart


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12), st.integers(1, 30), st.integers(1, 4))
def test_spectrum_follows_every_row(seed, size, count, spread):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-spread, spread + 1, size=(count, size)).astype(np.int64) + 1_000_000
    whole, first, second = Spectrum.empty(size), Spectrum.empty(size), Spectrum.empty(size)
    whole.add(*np.unique(rows, axis=0, return_counts=True))
    first.add(rows[: count // 2], np.ones(count // 2, dtype=np.int64))
    second.add(rows[count // 2 :], np.ones(count - count // 2, dtype=np.int64))
    first.merge(second)
    wanted = scatter(rows.astype(float))
    for s in (whole, first):
        assert s.n == count and s.sums == rows.sum(axis=0).tolist()
        scale = max(1.0, np.abs(wanted).max())
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - wanted).max() < 1e-11 * scale
        assert np.abs(s.vectors.T @ s.vectors - np.eye(size)).max() < 1e-11


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e3, 1e3), st.floats(1e-6, 10)), min_size=1, max_size=12, unique_by=lambda t: round(t[0], 3)))
def test_secular_roots(pairs):
    pairs.sort()
    poles, z = (np.array(x) for x in zip(*pairs))
    if len(poles) > 1 and np.diff(poles).min() < 1e-3:
        return
    origin, offset = secular_roots(poles, z * z, 0.7)
    wanted = np.linalg.eigvalsh(np.diag(poles) + 0.7 * np.outer(z, z))
    assert np.abs(poles[origin] + offset - wanted).max() < 1e-10 * max(1, np.abs(wanted).max())
