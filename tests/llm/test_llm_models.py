"""Kneser-Ney models, toxicity, quality, context mixing and the SentencePiece codec."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fixtures import ROWS, docs, labels, lower_words, plain
from waitspark.llm import bloom, context_mixing, kneser_ney, quality_classifier, sentencepiece_codec, toxicity
from waitspark.llm.kneser_ney import PLACES, Table, log_probabilities, train


def fold(doc_id, mod):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def test_table_finds_all_and_nothing_else():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    t = Table.of(keys, np.arange(1, len(keys) + 1))
    assert (t.get(keys) == np.arange(1, len(keys) + 1)).all()
    assert (t.get(keys + np.uint64(1), -1.0) == -1).all()
    assert (Table.of(keys[:0], np.zeros(0)).get(keys) == 0).all()


class PlainKneserNey:
    """Interpolated modified Kneser-Ney trigrams by the book, in dictionaries."""

    def __init__(self, texts):
        sequences = [["<s>", "<s>", *words, "</s>"] for words in texts if words]
        tri = Counter(tuple(s[i - 2 : i + 1]) for s in sequences for i in range(2, len(s)))
        bi = Counter(t[1:] for t in tri)
        uni = Counter(t[1:] for t in bi)
        self.levels = [self.level(c) for c in (uni, bi, tri)]
        self.uniform = 1 / (len(uni) + 1)

    @staticmethod
    def level(counts):
        n1, n2, n3, n4 = (sum(c == i for c in counts.values()) for i in (1, 2, 3, 4))
        if n1 and n2:
            y = n1 / (n1 + 2 * n2)
            d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 0]
            d[2] = 3 - 4 * y * n4 / n3 if n3 else d[1]
            d = [min(max(x, 0.05), i - 0.05) for i, x in enumerate(d, 1)]
        else:
            d = [0.5, 0.75, 0.9]
        total, given = Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            given[gram[:-1]] += d[min(c, 3) - 1]
        return counts, d, total, given

    def probability(self, gram):
        if not gram:
            return self.uniform
        counts, d, total, given = self.levels[len(gram) - 1]
        below = self.probability(gram[1:])
        if not total[gram[:-1]]:
            return below
        c = counts[gram]
        return ((c - d[min(c, 3) - 1] if c else 0) + given[gram[:-1]] * below) / total[gram[:-1]]

    def log_probability(self, words):
        s = ["<s>", "<s>", *words, "</s>"]
        grams = [tuple(s[i - 2 : i + 1]) for i in range(2, len(s))] if words else []
        return sum(math.log(self.probability(g)) for g in grams), sum(g in self.levels[2][0] for g in grams)


def zipf_texts(n, seed):
    rng = random.Random(seed)
    return [" ".join(f"v{int(rng.paretovariate(0.7))}" for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("hot_keys", [0, 40, 1 << 20])
def test_kneser_ney_equals_brute_force(spark, monkeypatch, hot_keys):
    """Whatever part of the model the tasks hold, and for texts longer than what they work on at once."""
    if hot_keys == 0:
        monkeypatch.setattr(kneser_ney, "WORD_ROWS", 0)
    trusted = zipf_texts(60, 1) + ["", None, "A b"]
    scored = zipf_texts(50, 2) + trusted + ["never seen words", "b", "", None, " \n", "a b"] + [" ".join(zipf_texts(9500, 3))]
    model = train(spark.createDataFrame([(t,) for t in trusted], "text string"), hot_keys)
    df = spark.createDataFrame(list(enumerate(scored)), "row int, text string").repartition(3)
    got = {r["row"]: r for r in log_probabilities(df, model, ["row"]).collect()}
    plain_model = PlainKneserNey([lower_words(t) for t in trusted])
    assert len(got) == len(scored)
    for i, text in enumerate(scored):
        log, known = plain_model.log_probability(lower_words(text))
        assert got[i]["n_words"] == len(lower_words(text)) and got[i]["known"] == known
        assert got[i]["log_probability"] == pytest.approx(log, rel=1e-5, abs=1e-4)
    assert len(lower_words(scored[-1])) > PLACES


def test_kneser_ney_over_many_shards(spark, monkeypatch):
    """Frequent middle words are dealt over several shards; what is shuffled is freed at once, and a trigram takes few bytes."""
    monkeypatch.setattr(kneser_ney, "SHARD_ROWS", 200)
    monkeypatch.setattr(kneser_ney, "SPLIT_ROWS", 30)
    trusted = zipf_texts(60, 1)
    scored = zipf_texts(50, 2) + trusted
    model = train(spark.createDataFrame([(t,) for t in trusted], "text string"), 5)
    assert model.shared.shards > 5 and model.shared.parts.max() > 3
    assert model.rows.filter(F.col("kind") == kneser_ney.SPLIT).count() > 3
    df = spark.createDataFrame(list(enumerate(scored)), "row int, text string").repartition(3)
    got = {r["row"]: r for r in log_probabilities(df, model, ["row"]).collect()}
    plain_model = PlainKneserNey([lower_words(t) for t in trusted])
    for i, text in enumerate(scored):
        log, known = plain_model.log_probability(lower_words(text))
        assert got[i]["known"] == known and got[i]["log_probability"] == pytest.approx(log, rel=1e-5, abs=1e-4)
    rng = np.random.default_rng(1)
    w = [np.minimum(rng.zipf(1.3, 20_000) + 2, 5000) for _ in range(3)]
    names = rng.integers(0, 2**64, 6000, dtype=np.uint64)
    blob = kneser_ney.pack_words(w, names, 5000)
    assert len(blob) < 6 * 20_000  # three names take 24 bytes
    assert all((names[a] == b).all() for a, b in zip(w, kneser_ney.unpack_words(blob, names[:5000])[1]))


def test_kneser_ney_sums_to_one(spark):
    """The next words, an end and an unseen word share one, after known, half known and unknown words."""
    trusted = ["a b c a b d a b c b a d c e a b", "b c a a e"]
    model = PlainKneserNey([t.split() for t in trusted])
    vocabulary = sorted({w for t in trusted for w in t.split()})
    for history in (("a", "b"), ("c", "a"), ("e", "e"), ("x", "y"), ("<s>", "<s>")):
        total = sum(model.probability((*history, w)) for w in [*vocabulary, "</s>", "zzz"])
        assert total == pytest.approx(1.0, abs=1e-9)
    # One word more changes the sum by that word's logarithm and the end's: what Spark gives agrees.
    texts = [f"a b {w}" for w in [*vocabulary, "zzz"]]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = log_probabilities(df, train(spark.createDataFrame([(t,) for t in trusted], "text string")), ["text"])
    for r in got.collect():
        assert r["log_probability"] == pytest.approx(model.log_probability(r["text"].split())[0], rel=1e-5)


def test_kneser_ney_without_text(spark):
    for nothing in ([], [(None,), ("",), (" ",)]):
        model = train(spark.createDataFrame(nothing, "text string"))
        rows = spark.createDataFrame([("a b",), (None,)], "text string")
        assert [tuple(r)[1:] for r in log_probabilities(rows, model, ["text"]).orderBy("n_words").collect()] == [(0, 0, 0), (2, 0, 0)]
        assert log_probabilities(rows.limit(0), model, ["text"]).collect() == []


def toy_corpus(n=900):
    rng = random.Random(5)
    common = [f"w{i}" for i in range(300)]
    bad = ["nasty", "vile", "awful"]
    rows, marks = [], []
    for i in range(n):
        text = [rng.choice(common) for _ in range(rng.randint(20, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randint(0, len(text)), rng.choice(bad))
        rows.append((i, " ".join(text), "en", "a", 1, "x", 1.0))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_toxicity_on_held_out_rows(spark):
    rows, marks = toy_corpus()
    got = toxicity.op8(docs(spark, rows + ROWS[3:6]), labels(spark, marks)).collect()
    assert len(got) == len(rows) + 3
    truth = {i: t for i, _, t in marks}
    assert all(r["held_out"] == (fold(r["doc_id"], 5) == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth and r["doc_id"] > 20]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)


def test_toxicity_ignores_held_out_labels(spark):
    rows, marks = toy_corpus(300)
    flipped = [(i, q, 1 - t if fold(i, 5) == 0 else t) for i, q, t in marks]
    a = toxicity.op8(docs(spark, rows), labels(spark, marks)).collect()
    b = toxicity.op8(docs(spark, rows), labels(spark, flipped)).collect()
    assert {r["doc_id"]: round(r["score"], 9) for r in a} == {r["doc_id"]: round(r["score"], 9) for r in b}


@pytest.mark.parametrize("marks", [[], [(1, 1, 0), (2, 1, None), (None, 1, 1)]])
def test_toxicity_without_two_classes(spark, marks):
    got = toxicity.op8(docs(spark), labels(spark, marks)).collect()
    assert len(got) == len(ROWS)
    assert len({r["score"] for r in got}) == 1


def test_quality_rejects_garbled_text(spark):
    rows, marks = toy_corpus(300)
    garbled = [(1000 + i, " ".join(f"q{i}z{k}" for k in range(60)), "en", "a", 1, "x", 1.0) for i in range(5)]
    got = quality_classifier.classify(docs(spark, rows + garbled + ROWS[3:6]), labels(spark, marks[:150])).collect()
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[1000 + i] for i in range(5))
    assert sum(kept[i] for i in range(150, 300)) >= 148 and all(kept[i] for i in range(30, 150))
    assert not kept[5] and not kept[6]


def test_quality_of_empty_tables(spark):
    assert quality_classifier.classify(docs(spark, []), labels(spark, [(1, 1, 0)])).collect() == []
    got = quality_classifier.classify(docs(spark), labels(spark, [])).collect()
    assert len(got) == len(ROWS)
    assert all(r["kept"] == (r["n_words"] > 0) for r in got)


def test_quality_limits_are_quantiles_of_held_back_rows(spark):
    """Junk within a few spreads of good text is beyond the limits; a language without held-back rows has its own."""
    held = spark.createDataFrame([("en", 9 + i / 1000) for i in range(1000)], "lang string, log_perplexity double")
    junk = [(lang, 10.5 + i / 100) for lang in ("en", None) for i in range(10)]
    new = held.unionByName(spark.createDataFrame(junk, held.schema))
    got = {r["_lang"]: (r["low"], r["high"]) for r in quality_classifier.limits(new, held).collect()}
    assert 8.85 < got["en"][0] < 9.12 and 9.88 < got["en"][1] < 10.15  # sketches are 1 % exact
    assert got[None][0] < 10.5 and got[None][1] > 10.59
    assert {r["_lang"] for r in quality_classifier.limits(new, held.limit(0)).collect()} == {"en", None}


def test_context_mixing_base_and_counts(spark):
    rows, _ = toy_corpus(300)
    rows = rows + [r for r in ROWS if r[0] != 7]
    got = context_mixing.score(docs(spark, rows)).collect()
    train_rows = [r for r in rows if fold(r[0], 7) != 2]
    counts = Counter(w for r in train_rows for w in lower_words(r[1]))
    counts[None] = len(train_rows)
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r in rows:
        tokens = [*lower_words(r[1]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        expected.append((r[0], fold(r[0], 7) == 2, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    found = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got]
    assert plain(found) == sorted(expected, key=repr)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] != 13]  # one word of 50,000 letters has to be spelt
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_spelling_is_a_distribution(spark):
    types = spark.createDataFrame([(f"ab{i % 50}c{i}".encode(),) for i in range(500)], "word binary")
    speller = context_mixing.train_speller(types)
    # All bytes as the first byte of a word, stops included, share one.
    total = 0.0
    slots, bit, last, word = context_mixing.bits_of([bytes([b]) for b in range(256) if b != 0x20] + [b""])
    x, gate = speller.inputs(slots, bit)
    p = speller.refined(speller.mixed(x, gate), last)
    first = np.where(bit == 1, p, 1 - p)
    place = np.arange(len(bit)) - np.searchsorted(word, word)
    for w in range(256):
        total += np.prod(first[(word == w) & (place < 8)])
    assert total == pytest.approx(1.0, abs=1e-6)
    assert speller.log10([b"ab7c8"])[0] > speller.log10([b"zqxjv"])[0]


def test_context_mixing_without_training_rows(spark):
    only_held = [(i, f"some text {i}", "en", "a", 1, "x", 1.0) for i in range(200) if fold(i, 7) == 2]
    got = context_mixing.score(docs(spark, only_held)).collect()
    assert len(got) == len(only_held)
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in got)
    assert context_mixing.score(docs(spark, [])).collect() == []


# SentencePiece


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_codec.load_pieces(sentencepiece_codec.default_model())


@pytest.fixture(scope="module")
def codec(pieces):
    return sentencepiece_codec.Encoder(pieces), sentencepiece_codec.Decoder(pieces)


def brute_best(pieces, text):
    """Best total score over all segmentations, by plain dynamic programming."""
    score = {t: s for t, s in ((pieces.texts[i], pieces.scores[i]) for i in pieces.texts)}
    unknown = min(pieces.scores.values()) - sentencepiece_codec.UNKNOWN_PENALTY
    marked = "▁" + text.replace("▁", "￿").replace(" ", "▁")
    best = [0.0] + [-math.inf] * len(marked)
    for end in range(1, len(marked) + 1):
        best[end] = best[end - 1] + unknown
        for start in range(max(0, end - 48), end):
            best[end] = max(best[end], best[start] + score.get(marked[start:end], -math.inf))
    return best[-1]


@settings(deadline=None, max_examples=60)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40) | st.text("ab the\n  ▁￿é漢", max_size=40))
def test_codec_round_trip(codec, text):
    encode, decode = codec
    ids, _ = encode(text)
    assert decode(ids.tolist()) == text


@settings(deadline=None, max_examples=60)
@given(st.text("ab theingor\n ▁é漢ü,.", max_size=40))
def test_viterbi_is_best(pieces, codec, text):
    ids, score = codec[0](text)
    assert score == pytest.approx(brute_best(pieces, text) if text else 0.0)


def test_ids_are_pieces_of_the_text(pieces, codec):
    ids, _ = codec[0]("the thing")
    assert "".join(pieces.texts[i] for i in ids.tolist()) == "▁the▁thing"


def test_codec_query(spark):
    got = sentencepiece_codec.op1(docs(spark)).collect()
    assert len(got) == len(ROWS)
    assert all(r["round_trip"] for r in got)
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    empty = [r for r in got if r["doc_id"] in (4, 5)]
    assert all(r["ids"] == [] and r["score"] == 0 for r in empty)


def test_encode_carries_columns_and_replaces_its_own(spark):
    df = docs(spark)
    coded = sentencepiece_codec.encode(df)
    assert coded.columns == ["doc_id", "text", "lang", "source", "n_chars", "word", "ids", "n_tokens", "score"]
    assert {r["word"] for r in coded.collect()} == {"x", None}
    assert sentencepiece_codec.decode(sentencepiece_codec.encode(docs(spark, []))).collect() == []


def test_quality_model_learns_from_every_trusted_row(spark, monkeypatch):
    rows = spark.range(8000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.lit("one two").alias("text"))
    marks = rows.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    learnt = []
    monkeypatch.setattr(quality_classifier, "train", lambda texts: learnt.append(texts.count()))
    quality_classifier.fit(rows, marks)
    assert learnt == [rows.filter(~quality_classifier.held_back()).count()] and learnt[0] > 6000


def test_quality_model_learns_from_trusted_rows_only(spark, monkeypatch):
    """Also where the filter of ids takes all; a null id is nobody's."""
    monkeypatch.setattr(bloom, "SLOTS", 2)
    rows = spark.range(900).select(F.when(F.col("id") > 0, F.col("id")).alias("doc_id"), F.lit("one two").alias("text"))
    marks = rows.select("doc_id", (F.coalesce("doc_id", F.lit(3)) % 3 == 0).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    learnt = []
    monkeypatch.setattr(quality_classifier, "train", lambda texts: learnt.extend(r["doc_id"] for r in texts.collect()))
    quality_classifier.fit(rows, marks)
    assert sorted(learnt) == [i for i in range(3, 900, 3) if fold(i, 5) != 0]
