"""Rows with every awkward case, and helpers to compare with brute force."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(200))
NEAR = BASE.replace("word57", "other57")

#: doc_id, text, lang, source, n_chars, and columns whose names operators use themselves.
ROWS = [
    (1, BASE, "en", "a", 1, "x", 1.0),
    (2, NEAR, "en", "a", 1, "x", 1.0),
    (3, BASE.replace(" ", "\n"), "de", "b", 1, "x", 1.0),
    (4, None, "en", "a", 1, "x", 1.0),
    (5, "", None, None, 1, None, None),
    (6, " \t\n", "en", None, 1, "x", 1.0),
    (7, LONG, "en", "b", 1, "x", 1.0),
    (8, "one two", "fr", "c", 1, "x", 1.0),
    (8, "one two", "fr", "c", 1, "x", 1.0),
    (9, "ONE  two", "fr", "c", 1, "x", 1.0),
    (10, "ça va #tag | naïve ▁ ￿ 漢字 ÿ", "fr", "c", 1, "x", 1.0),
    (None, "no id here", None, "c", None, "x", 1.0),
    (12, "line one\nline two\nline one\n \nline one " + "again " * 40, "en", "d", 1, "x", 1.0),
    (13, "x" * 50_000, "en", "d", 1, "x", 1.0),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("word", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def docs(spark, rows=None):
    return spark.createDataFrame(ROWS if rows is None else rows, SCHEMA).repartition(3)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words(text):
    return (text or "").encode().split()


def lower_words(text):
    return (text or "").encode().lower().split()


def plain(rows):
    return sorted((tuple(r) for r in rows), key=repr)
