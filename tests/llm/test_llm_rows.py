"""Quality rules, mixing, exact dedup and the files of token ids against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fixtures import ROWS, docs, plain, words
from waitspark.llm import bloom, exact_dedup, mixing, quality_rules, registry, token_files

SMALL = "/root/testdata/sf0.001"


def compare_with_sql(spark, name):
    import duckdb

    from check import table

    df = registry.QUERIES[name](spark, SMALL)
    got = table(df.columns, df.collect())
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
        result = db.execute(registry.ORACLE[name])
        names = [d[0] for d in result.description]
        expected = table(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(registry.ORACLE) - {"pipeline"}))
def test_sql(spark, name):
    compare_with_sql(spark, name)


# Quality rules


def brute_measures(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if x.strip(" \t\v\f\r")]
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(8)}
    return (
        len(w),
        sum(len(x.decode()) for x in w),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures(spark):
    got = quality_rules.quality_rules(docs(spark)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    expected = []
    for doc_id, text, *_ in ROWS:
        m = brute_measures(text)
        expected.append((doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert plain(got.collect()) == sorted(expected, key=repr)


def test_sketch_quantiles_are_close(spark):
    values = [(i % 3, float(v)) for i, v in enumerate(np.random.default_rng(1).lognormal(0, 2, 3000))] + [(0, 0.0)] * 50
    df = spark.createDataFrame(values, "g int, v double")
    got = quality_rules.quantiles(quality_rules.sketches(df, ["g"], ["v"]), ["g"], {"q1": 0.25, "q3": 0.75}).collect()
    for r in got:
        own = np.sort([v for g, v in values if g == r["g"]])
        for q in ("q1", "q3"):
            exact = own[int(np.ceil(len(own) * {"q1": 0.25, "q3": 0.75}[q])) - 1]
            assert r[q] == pytest.approx(exact, rel=2.1 * quality_rules.ACCURACY, abs=1e-6)


def test_outliers_of_a_group_fail(spark):
    normal = [(i, " ".join(f"a{i}b{k}" for k in range(50)), "en", "a", 1, "x", 1.0) for i in range(60)]
    odd = [(100, " ".join(f"a{k}###$$$" for k in range(50)), "en", "a", 1, "x", 1.0)]
    got = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs(spark, normal + odd)).collect()}
    assert not got.pop(100)
    assert all(got.values())


def test_no_python_in_quality_rules(spark):
    plan = quality_rules.quality_rules(docs(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# Mixing


def brute_targets(sizes, weights, cap):
    """The rule as the contract words it: share by weight, stop at the cap, reshare the excess."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, active, left = {}, set(order), float(sum(sizes.values()))
    while active:
        total = sum(weight[s] for s in active)
        over = {s for s in active if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in active}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        active -= over
    return target


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=9))
def test_targets(spark, sizes):
    named = {None if i == 4 else f"s{i}": n for i, n in enumerate(sizes)}
    df = spark.createDataFrame([(s, n, 1) for s, n in named.items()], "source string, source_size long, n_docs long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    assert got == pytest.approx(brute_targets(named, mixing.WEIGHTS, mixing.MAX_COPIES))


def test_mix_comes_near_its_targets(spark):
    rows = [(100 + i, "w " * (1 + i * 7 % 90), "en", f"s{min(i % 7, 3)}", 1, "x", 1.0) for i in range(600)] + ROWS
    got = mixing.op3(docs(spark, rows)).join(docs(spark, rows).select("doc_id", "source").distinct(), "doc_id").collect()
    assert len(mixing.op3(docs(spark, rows)).collect()) == len(rows)
    by_source = {}
    for r in got:
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        s = by_source.setdefault(r["source"], [0, r["target"], 0])
        s[0] += r["taken"]
        s[2] = max(s[2], r["size"])
    for taken, target, longest in by_source.values():
        assert abs(taken - target) <= longest + 1
    assert plain(mixing.op3(docs(spark, rows)).collect()) == plain(mixing.op3(docs(spark, rows)).collect())


def test_mix_emits_what_the_plan_takes(spark):
    df = docs(spark)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    emitted = Counter(r["doc_id"] for r in mixed.collect())
    planned = Counter()
    for r in mixing.plan(df, ["doc_id"]).collect():
        planned[r["doc_id"]] += r["copies"]
    # Rows of one size may trade places with their twins, so totals by text length are compared.
    size = {r[0]: len(words(r[1])) for r in ROWS}
    total = lambda c: sum(n * size[i] for i, n in c.items())
    assert total(emitted) == total(planned)


# Exact dedup


def brute_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups.setdefault(digest, []).append(doc_id)
    return groups


def test_exact_classes(spark):
    many = ROWS + [(1000 + i, "the same text", "en", "a", 1, "x", 1.0) for i in range(300)]
    got = exact_dedup.op4(docs(spark, many)).collect()
    groups = brute_groups(many)
    assert len(got) == len(many)
    for digest, ids in groups.items():
        rows = [r for r in got if r["text_sha256"] == digest]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, ids))
        assert {(r["keep_id"], r["group_size"]) for r in rows} == {(keep, len(ids))}
        assert [r["doc_id"] for r in rows if r["kept"]] == [keep]


def test_deduplicate_keeps_one_row_of_each_text(spark):
    df = docs(spark)
    got = exact_dedup.deduplicate(df)
    assert got.columns == df.columns
    kept = got.collect()
    groups = brute_groups(ROWS)
    assert len(kept) == len(groups)
    assert {str(r["doc_id"]) for r in kept} == {str(min((i for i in ids if i is not None), default=None)) for ids in groups.values()}


@given(st.sets(st.integers(0, 2**20 - 1), min_size=1, max_size=300))
def test_rice_code(values):
    sorted_values = np.array(sorted(values), dtype=np.int64)
    for k in (0, 3, exact_dedup.rice_width(len(values), 1 << 20)):
        unary, rest = exact_dedup.rice_encode(sorted_values, k)
        assert (exact_dedup.rice_decode(unary, rest, k, len(values)) == sorted_values).all()


def test_suspects_are_few_and_complete(spark):
    rows = [(i, f"text {i % 900}", "en", "a", 1, "x", 1.0) for i in range(1000)]
    prints = exact_dedup.fingerprints(docs(spark, rows))
    found = exact_dedup.suspects(prints).join(prints, "row_id").select("doc_id").collect()
    ids = {r["doc_id"] for r in found}
    assert {i for i in range(1000) if i % 900 < 100} <= ids
    assert len(ids) < 300


def test_coded_lists_stand_for_their_rows():
    rng = np.random.default_rng(5)
    fps, row_ids = rng.integers(0, 1 << 12, 3000), rng.permutation(1 << 40 | np.arange(3000))
    lists = list(exact_dedup.coded_lists(row_ids, fps, 8))
    assert [x[1] for x in lists] == sorted(set((fps >> 8).tolist()))
    assert len({x[0] for x in lists}) == len(lists)
    fp_of, seen = dict(zip(row_ids.tolist(), fps.tolist())), []
    for _, owner, n, k, unary, rest, twice, first, ids in lists:
        values = exact_dedup.rice_decode(unary, rest, k, n) + (owner << 8)
        place = np.cumsum(np.unpackbits(np.frombuffer(first, np.uint8))[: len(ids)]) - 1
        assert [fp_of[i] for i in ids.tolist()] == values[place].tolist()
        repeated = np.unpackbits(np.frombuffer(twice, np.uint8))[:n] > 0
        assert (repeated == (np.bincount(place) > 1)).all()
        seen += ids.tolist()
    assert sorted(seen) == sorted(row_ids.tolist())


@pytest.mark.parametrize("slots", [2, bloom.SLOTS])
def test_exact_classes_with_short_lists_and_a_full_filter(spark, monkeypatch, slots):
    monkeypatch.setattr(exact_dedup, "LIST_ROWS", 50)
    monkeypatch.setattr(bloom, "SLOTS", slots)
    rows = [(i, f"text {i % 900}" if i % 3 else "copy", "en", "a", 1, "x", 1.0) for i in range(1200)]
    got = {r["doc_id"]: r for r in exact_dedup.op4(docs(spark, rows)).collect()}
    groups = brute_groups(rows)
    assert len(got) == len(rows)
    for digest, ids in groups.items():
        for i in ids:
            assert (got[i]["text_sha256"], got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (digest, min(ids), len(ids), i == min(ids))
    kept = exact_dedup.deduplicate(docs(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(min(ids) for ids in groups.values())


def test_unique_texts_stay_where_they_are(spark):
    rows = [(i, f"text {i % 9000}", "en", "a", 1, "x", 1.0) for i in range(9300)]
    df = docs(spark, rows)
    suspect = exact_dedup.classes(df).filter("group_size > 1")
    held = bloom.bloom_filter(suspect, "text_sha256")
    assert 0 < held.count() <= 300
    moved = exact_dedup.suspect_texts(df, held)
    assert 600 <= moved.count() < 620
    plan = moved.distinct()._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("hashpartitioning") :]
    assert "BroadcastHashJoin" in before and before.index("HashAggregate") < before.index("BroadcastHashJoin")
    whole = exact_dedup.deduplicate(df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in whole.split("Exchange hashpartitioning")[0]


# Token files


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=200))
def test_block_round_trip(ids):
    x = np.array(ids, dtype=np.uint32)
    assert (token_files.decode_block(token_files.encode_block(x)) == x).all()


def test_block_patches_outliers():
    x = np.array([5] * 99 + [2**31], dtype=np.uint32)
    data = token_files.encode_block(x)
    assert len(data) < 30
    assert (token_files.decode_block(data) == x).all()


def test_reader_begins_at_any_block(tmp_path):
    from pyarrow import fs

    x = np.random.default_rng(2).integers(0, 50_000, 3 * token_files.BLOCK + 17).astype(np.uint32)
    path = str(tmp_path / "f")
    with open(path, "wb") as out:
        writer = token_files.BlockWriter(out)
        for part in np.array_split(x, 40):
            writer.add(part)
        writer.close()
    reader = token_files.BlockReader(fs.LocalFileSystem().open_input_file(path))
    assert reader.total == len(x)
    for first, last in [(0, 0), (0, 1), (4095, 4097), (9000, len(x))]:
        assert (reader.ids(first, last) == x[first:last]).all()


def test_token_files(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = token_files.op10(docs(spark)).collect()
    start, expected = 0, []
    for doc_id, text in sorted(((r[0], r[1] or "") for r in ROWS), key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, token_files.END_ID]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert plain(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("f", [quality_rules.quality_rules, mixing.op3, mixing.mix, exact_dedup.op4, exact_dedup.deduplicate, token_files.op10])
def test_empty_table(spark, f):
    assert f(docs(spark, [])).collect() == []


EDGED = st.lists(
    st.sampled_from(["Word", "été", "naïve", "'s", "it's", "...", "!", "12", "<|endoftext|>", "|", "<", "…", "x", "漢字", "É", "-", "́", "(", "İ", "ß"]),
    max_size=6,
)


@settings(max_examples=200, deadline=None)
@given(st.lists(EDGED, max_size=8))
def test_chunk_edges_do_not_change_the_ids(chunks):
    import public_tokenizers

    encoder = token_files.chunk_encoder(public_tokenizers.path("word_bpe_49k.json"))
    text = " ".join("".join(c) for c in chunks)
    wanted = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(text.encode()).tolist() == wanted
