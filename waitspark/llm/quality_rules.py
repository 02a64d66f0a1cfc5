"""Quality rules whose thresholds come from mergeable quantile sketches by language and source.

Only built-in expressions run here. The measures of a text are array expressions over its own words
and lines. A sketch is a histogram over geometric buckets: bucket b holds the values in
(GAMMA**(b-1), GAMMA**b], zero has its own, so any quantile is found within ``ACCURACY`` of its
value, sketches merge by adding counts, and neither order nor partitioning changes them. Spark's
partial aggregation merges inside the tasks first, so a hot source costs no more than a small one.

Null text counts as a text without words. Null language or source is a group of its own. A repeated
row is judged like its twin. Empty input gives an empty result. Columns other than the named ones
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waitspark.llm.common import SPACE, text_or_empty
from waitspark.workspace import materialize

SYMBOLS = "#*$%&|<>"
WINDOW_WORDS = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
SMALLEST = 1e-6

#: Measure -> (low side too, spread that counts at least, spreads beyond the quartile that fail).
RULES = {
    "mean_word": (True, 0.5, 6.0),
    "symbol_rate": (False, 0.02, 4.0),
    "dup_line_rate": (False, 0.10, 3.0),
    "repeat_rate": (False, 0.05, 4.0),
}


def _words(text: Column) -> Column:
    """Words of ``text``; the split leaves an empty first or last element where space ends it."""
    return F.array_remove(F.split(text, SPACE), "")


def measures(docs: DataFrame, carry: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, ``carry`` and the counts the rules need, one row per row of ``docs``."""
    text = text_or_empty()
    base = docs.select("doc_id", *carry, text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.trim(F.translate(line, "\t\v\f\r", "    ")) != "")
    base = base.select(
        "doc_id",
        *carry,
        _words(F.col("_text")).alias("_words"),
        lines.alias("_lines"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", SPACE, "")).cast("long").alias("word_chars"),
    )
    base = base.select(
        "doc_id",
        *carry,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    at = lambda i: F.get("_hashes", i)
    windows = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - WINDOW_WORDS),
        lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW_WORDS)]),
    )
    base = base.withColumn(
        "_windows", F.when(F.col("n_words") > WINDOW_WORDS, windows).otherwise(F.array().cast("array<bigint>"))
    )
    return base.select(
        "doc_id",
        *carry,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(
            F.size(F.array_distinct("_windows")) < F.size("_windows"), _covered("_windows")
        ).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
    )


def _covered(windows: str) -> Column:
    """Words inside windows that occur twice: sort (hash, place), keep equal neighbours, add steps."""
    placed = F.array_sort(
        F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    # One pass over the sorted pairs: a place counts if its hash equals the one before or after.
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), placed)
    after = F.concat(F.slice(placed, 2, F.greatest(F.size(placed) - 1, F.lit(0))), F.array(F.lit(None).cast("struct<h:bigint,i:int>")))
    triples = F.arrays_zip(placed.alias("p"), before.alias("b"), after.alias("a"))
    repeated = F.filter(
        triples,
        lambda t: t["p"].isNotNull() & (
            (t["p"]["h"] == F.coalesce(t["b"]["h"], t["p"]["h"] + 1))
            | (t["p"]["h"] == F.coalesce(t["a"]["h"], t["p"]["h"] + 1))
        ),
    )
    places = F.array_sort(F.transform(repeated, lambda t: t["p"]["i"]))
    steps = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW_WORDS).alias("last")),
        lambda s, i: F.struct(
            (s["n"] + F.least(F.lit(WINDOW_WORDS), i - s["last"])).cast("long").alias("n"), i.alias("last")
        ),
        lambda s: s["n"],
    )
    return steps


def rates(df: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return df.withColumns(
        {
            "mean_word": F.col("word_chars") / words,
            "symbol_rate": F.col("n_symbols") / words,
            "dup_line_rate": F.col("n_dup_lines") * MIN_WORDS / F.greatest(words, F.lit(MIN_WORDS)),
            "repeat_rate": F.col("n_repeat_words") / words,
        }
    )


def bucket(value: Column) -> Column:
    """Sketch bucket of a value of zero or more; null stays null."""
    b = F.ceil(F.log(F.greatest(value, F.lit(SMALLEST))) / math.log(GAMMA)).cast("int")
    return F.when(value <= 0, F.lit(-(2**31)).cast("int")).otherwise(b)


def bucket_value(b: Column) -> Column:
    """A value within ACCURACY of all of bucket ``b``."""
    return F.when(b == -(2**31), F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), b) * 2 / (GAMMA + 1))


def sketches(df: DataFrame, groups: list[str], names: list[str]) -> DataFrame:
    """(groups, measure, bucket, n): one mergeable sketch per group and measure."""
    long = df.select(
        *groups,
        F.explode(F.array(*[F.struct(F.lit(n).alias("measure"), bucket(F.col(n)).alias("bucket")) for n in names])).alias("_m"),
    )
    return long.groupBy(*groups, "_m.measure", "_m.bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, groups: list[str], points: dict[str, float]) -> DataFrame:
    """A column per point: the value of the bucket that holds that rank of the group's rows."""
    group = Window.partitionBy(*groups, "measure")
    ranked = sketch.withColumns(
        {
            "_upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
            "_all": F.sum("n").over(group),
        }
    )
    return ranked.groupBy(*groups, "measure").agg(
        *[
            F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * q), bucket_value(F.col("bucket")))).alias(name)
            for name, q in points.items()
        ]
    )


def thresholds(df: DataFrame, groups: list[str]) -> DataFrame:
    """A row per group with <measure>_low and <measure>_high."""
    found = quantiles(sketches(df, groups, list(RULES)), groups, {"q1": 0.25, "q3": 0.75})
    columns = []
    for name, (low, least, times) in RULES.items():
        of = F.col("measure") == name
        spread = F.greatest(F.col("q3") - F.col("q1"), F.lit(least)) * times
        columns.append(F.max(F.when(of, F.col("q3") + spread)).alias(f"{name}_high"))
        if low:
            columns.append(F.max(F.when(of, F.col("q1") - spread)).alias(f"{name}_low"))
    return found.groupBy(*groups).agg(*columns)


def quality_rules(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, counts, base_failed and kept for each row of ``docs``.

    ``kept`` is false where the fixed floor fails (too short, or mostly repeated windows) or where a
    measure lies beyond its group's threshold.
    """
    measured = materialize(measures(docs, groups), "quality")
    rated = rates(measured)
    keys = [f"_k{i}" for i in range(len(groups))]
    limits = thresholds(rated, list(groups)).withColumnsRenamed(dict(zip(groups, keys)))
    limits = materialize(limits, "limits")
    same = F.lit(True)
    for g, k in zip(groups, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    beyond = F.lit(False)
    for name, (low, _, _) in RULES.items():
        beyond = beyond | (F.col(name) > F.col(f"{name}_high"))
        if low:
            beyond = beyond | (F.col(name) < F.col(f"{name}_low"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rated.join(limits, same, "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~F.coalesce(beyond, F.lit(False))).alias("kept"),
    )


def _sql() -> str:
    """The same in SQL: measures, sketches as bucket counts, limits by language and source."""
    space = r" \t\n\x0B\f\r"
    symbols = SYMBOLS.replace("'", "''")
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{m}' AS measure, {m} AS v FROM rated" for m in RULES
    )
    limits, beyond = [], []
    for m, (low, least, times) in RULES.items():
        reach = f"greatest(q3 - q1, {least}) * {times}"
        limits.append(f"max(CASE WHEN measure = '{m}' THEN q3 + {reach} END) AS {m}_high")
        beyond.append(f"{m} > {m}_high")
        if low:
            limits.append(f"max(CASE WHEN measure = '{m}' THEN q1 - {reach} END) AS {m}_low")
            beyond.append(f"{m} < {m}_low")
    zero = -(2**31)
    value = f"CASE WHEN bucket = {zero} THEN 0 ELSE pow({GAMMA!r}::DOUBLE, bucket) * 2 / ({GAMMA!r}::DOUBLE + 1) END"
    return f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT *, regexp_extract_all(t, '[^{space}]+') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{space}]')) AS lines
  FROM texts),
windows AS (
  SELECT row, i, list_slice(words, i, i + {WINDOW_WORDS - 1}) AS win
  FROM (SELECT row, words, unnest(range(1, len(words) - {WINDOW_WORDS - 2})) AS i FROM parts
        WHERE len(words) > {WINDOW_WORDS})),
repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, win) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT row, count(DISTINCT i + k) AS n FROM repeated, range({WINDOW_WORDS}) s(k) GROUP BY row),
measured AS (
  SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{symbols}', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words
  FROM parts LEFT JOIN covered USING (row)),
rated AS (
  SELECT *, word_chars / greatest(n_words, 1)::DOUBLE AS mean_word,
         n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_rate,
         n_dup_lines * {MIN_WORDS} / greatest(n_words, {MIN_WORDS})::DOUBLE AS dup_line_rate,
         n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_rate
  FROM measured),
sketch AS (
  SELECT lang, source, measure, bucket, count(*) AS n
  FROM (SELECT *, CASE WHEN v <= 0 THEN {zero}
                       ELSE CAST(ceil(ln(greatest(v, {SMALLEST})) / {math.log(GAMMA)!r}) AS INTEGER) END AS bucket
        FROM ({long}))
  GROUP BY ALL),
ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bucket) AS upto,
         sum(n) OVER (PARTITION BY lang, source, measure) AS total
  FROM sketch),
quartile AS (
  SELECT lang, source, measure, min(CASE WHEN upto >= ceil(total * 0.25) THEN {value} END) AS q1,
         min(CASE WHEN upto >= ceil(total * 0.75) THEN {value} END) AS q3
  FROM ranked GROUP BY ALL),
limits AS (SELECT lang, source, {", ".join(limits)} FROM quartile GROUP BY ALL),
judged AS (
  SELECT r.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         {" OR ".join(beyond)} AS beyond
  FROM rated r JOIN limits l
    ON r.lang IS NOT DISTINCT FROM l.lang AND r.source IS NOT DISTINCT FROM l.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(beyond, false) AS kept
FROM judged
"""


SQL = _sql()
