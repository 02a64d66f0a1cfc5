"""Toxicity by two class-conditional Kneser-Ney models of text.

Both classes share their lowest level: an expression's weight there is the number of classes that
have it, so an expression seen in one class costs the other little, and a rare one next to nothing
either way. Above it a class counts, for each word, the different words seen before it, and, for word
pairs that at least ``PAIR_DOCUMENTS`` training documents hold, those documents; rarer pairs
fall back to the shared levels. The score of a text compares its log-likelihoods per word in both
classes; a small logistic fit on held-back training labels turns the comparison (mean, mean times root
of length, and the mean of its strongest words) into a probability.

Labels come only from rows with crc32(doc_id as text) mod 5 not 0; of these, remainder 4 serves the
logistic fit. Models are fitted on at most ``FIT_ROWS`` and ``CALIBRATION_ROWS`` documents of each
class, those of the smallest hash of their id. Language, source, id and labels are no inputs of a score.

Null text counts as empty; a text without words has all features 0, so it scores as the
logistic fit does without evidence. A
label given twice counts as its larger value, a null label is none. Repeated rows score alike. If one
class has no labels, every score is the share of toxic training labels. Empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitspark.llm.common import WordHashes, binary_texts, bounded_sample, fold, text_or_empty
from waitspark.llm.kneser_ney import Table, before, discount, discounts, names, ngram_rows, text_hashes, to_table
from waitspark.workspace import materialize

FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
FIT_ROWS = 5_000
CALIBRATION_ROWS = 2_000
PAIR_DOCUMENTS = 5
#: Words whose comparison is averaged as the strongest.
STRONGEST = 2
RIDGE = 1.0


@dataclass
class ToxicModel:
    #: For each word, log P(word | toxic) - log P(word | ordinary) from the word level.
    words: tuple[Table, Table]
    unseen: tuple[float, float]
    pairs: tuple[Table, Table]
    shares: tuple[Table, Table]
    prior: float
    weights: np.ndarray | None = None
    scale: np.ndarray | None = None

    def compare(self, h: np.ndarray) -> np.ndarray:
        """Of each word the log-likelihood under toxic less that under ordinary."""
        words, pairs = names(h, 2)
        context = before(h, 1)
        logs = []
        for k in (0, 1):
            p = self.words[k].get(words, self.unseen[k])
            p = self.pairs[k].get(pairs) + self.shares[k].get(context, 1.0) * p
            logs.append(np.log(p))
        return logs[1] - logs[0]

    def features(self, h: np.ndarray) -> np.ndarray:
        if not len(h):
            return np.zeros(3)
        ratio = self.compare(h)
        k = min(STRONGEST, len(ratio))
        top = np.partition(ratio, len(ratio) - k)[-k:]
        return np.array([ratio.mean(), ratio.mean() * np.sqrt(len(ratio)), top.sum() / STRONGEST])

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(features), self.prior)
        z = np.column_stack([np.ones(len(features)), features / self.scale]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic, fold of the labelled rows that may be learnt from."""
    found = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    found = found.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    return found.withColumn("fold", fold("doc_id", FOLDS)).filter(F.col("fold") != HELD_OUT)


def sample(labels: DataFrame, rows: int, calibration_rows: int) -> DataFrame:
    """doc_id, toxic, part (fit or calibrate): a bounded number of each."""
    parts = []
    for toxic in (0, 1):
        of = labels.filter(F.col("toxic") == toxic)
        for part, at, n in (("fit", F.col("fold") != CALIBRATION, rows), ("calibrate", F.col("fold") == CALIBRATION, calibration_rows)):
            parts.append(bounded_sample(of.filter(at), F.col("doc_id"), n).select("doc_id", "toxic", F.lit(part).alias("part")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> ToxicModel:
    labels = materialize(training_labels(labels), "toxic-labels")
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    chosen = materialize(sample(labels, rows, calibration_rows), "toxic-sample")
    texts = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    texts = materialize(texts, "toxic-texts")
    model = _class_models(texts.filter("part = 'fit'"), prior)
    if 0 in counts and 1 in counts:
        _calibrate(model, texts.filter("part = 'calibrate'"), counts)
        if model.weights is None:
            # Too few labels to hold some back: likelihoods and the prior as Bayes has them.
            model.scale = np.ones(3)
            model.weights = np.array([np.log(prior / (1 - prior)), 0.0, 1.0, 0.0])
    return model


def _class_models(texts: DataFrame, prior: float) -> ToxicModel:
    grams = ngram_rows(texts.select("toxic", "doc_id", "text"), 2, ["toxic", "doc_id"])
    level = grams.select("toxic", "doc_id", "g1", "g2", "c2").distinct()
    level = level.groupBy("toxic", "g1", "g2", "c2").agg(F.count("*").alias("n"))
    level = materialize(level, "toxic-pairs")
    # Pairs: documents of each class; only pairs that enough documents hold.
    common = level.groupBy("g2").agg(F.sum("n").alias("all")).filter(F.col("all") >= PAIR_DOCUMENTS).select("g2")
    totals = level.groupBy("toxic", "c2").agg(F.sum("n").alias("total"))
    d = _discounts(level)
    held = level.join(common, "g2", "left_semi").join(totals, ["toxic", "c2"])
    held = materialize(held.withColumn("weight", (F.col("n") - discount(F.col("n"), d)) / F.col("total")), "toxic-held")
    shares = held.groupBy("toxic", "c2").agg((1 - F.sum("weight")).alias("share"))
    # Words: different words before, in each class; below, the number of classes that have the word.
    words = level.groupBy("toxic", "g1").agg(F.count("*").alias("n"))
    words = materialize(words, "toxic-words")
    d1 = _discounts(words)
    by_class = {r["toxic"]: r for r in words.groupBy("toxic").agg(F.sum("n").alias("total"), F.sum(discount(F.col("n"), d1)).alias("given")).collect()}
    both = words.groupBy("g1").agg(
        F.count("*").alias("classes"), *[F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (0, 1)]
    )
    both = materialize(both, "toxic-both")
    size = both.agg(F.sum("classes").alias("s"), F.count("*").alias("v")).first()
    below = (size["s"] or 0) + (size["v"] or 0) + 1
    tables, unseen = [], []
    for k in (0, 1):
        total, given = (by_class[k]["total"], by_class[k]["given"]) if k in by_class else (1, 1.0)
        n = F.col(f"n{k}")
        p = (n - discount(n, d1)) / total + F.col("classes") * (given / total / below)
        tables.append(to_table(both.withColumn("p", p), "g1", "p"))
        unseen.append(given / total / below)
    pairs = tuple(to_table(held.filter(F.col("toxic") == k), "g2", "weight") for k in (0, 1))
    left = tuple(to_table(shares.filter(F.col("toxic") == k), "c2", "share") for k in (0, 1))
    return ToxicModel(tuple(tables), tuple(unseen), pairs, left, prior)


def _discounts(level: DataFrame) -> tuple[float, float, float]:
    of = level.groupBy(F.least(F.col("n"), F.lit(5)).alias("n")).agg(F.count("*").alias("m"))
    return discounts({r["n"]: r["m"] for r in of.collect()})


def _calibrate(model: ToxicModel, texts: DataFrame, counts: dict[int, int]) -> None:
    got = _features(texts.select("toxic", "text"), ["toxic"], model).toArrow()
    y = got.column("toxic").to_numpy().astype(float)
    if not (0 < y.sum() < len(y)) or min(y.sum(), len(y) - y.sum()) < 5:
        return
    x = np.column_stack([got.column(f"f{i}").to_numpy() for i in range(3)])
    model.scale = np.maximum(np.abs(x).mean(axis=0), 1e-9)
    x = np.column_stack([np.ones(len(x)), x / model.scale])
    # Rows weigh as their class does among all training labels.
    share = np.where(y == 1, counts[1] / y.sum(), counts[0] / (len(y) - y.sum())) * len(y) / (counts[0] + counts[1])
    w = np.zeros(4)
    ridge = np.diag([1e-6, *[RIDGE / len(y) * 10] * 3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (share * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(4), x.T @ (share * (y - p)) - ridge @ w
        )
        w = w + step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    model.weights = w


def _features(rows: DataFrame, carry: list[str], model: ToxicModel) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, m = WordHashes(), shared.value
        for batch in batches:
            found = [m.features(text_hashes(t, cache)) for t in binary_texts(batch.column(len(carry)))]
            x = np.array(found).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(carry)], *[pa.array(x[:, i]) for i in range(3)], pa.array(m.scores(x))],
                names=[*carry, "f0", "f1", "f2", "score"],
            )

    kinds = dict(rows.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in carry] + ["f0 double", "f1 double", "f2 double", "score double"])
    return rows.select(*carry, "text").mapInArrow(run, schema)


def score(docs: DataFrame, model: ToxicModel, carry: tuple[str, ...] = ("doc_id",), into: str = "score") -> DataFrame:
    """``carry`` and the score, in column ``into``, for each row of ``docs``."""
    own = [f"_c{i}" for i in range(len(carry))]
    rows = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(carry, own)], text_or_empty().alias("text"))
    found = _features(rows, own, model)
    return found.select(*[F.col(o).alias(c) for c, o in zip(carry, own)], F.col("score").alias(into))


def op8(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
